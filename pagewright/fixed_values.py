"""Lists, tables, thresholds and patterns that results depend on."""

from __future__ import annotations

# --- whitespace -------------------------------------------------------------
# The Unicode-wide whitespace set, spelled out because the regex engines differ on \s.
WS = r"\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"

# --- inventory --------------------------------------------------------------
SKIP_DIRS = ("node_modules", ".git")
SKIP_NAMES = ("desktop.ini", ".DS_Store")
SKIP_EXTENSIONS = (".gscript", ".ini")
SKIP_PATTERN = r"(?i)\.private\.(json|gs)$"

HASH_PREFIX_BYTES = 8 * 1024 * 1024
HASH_HEX = 16
PROBE_PAGES = 8
ROTATION_PAGES = 3

PAST_PAPER_FOLDER = "국시 기출문제"
ANSWER_SHEET_WORD = "최종답안"
STUDY_GUIDE_WORD = "공부가이드"
D_GRADE_WORD = "D등급"
COPY_SUFFIX = "의 사본"

NOTE_EXTENSIONS = (".md", ".txt")
AUDIO_EXTENSIONS = (".mp3", ".m4a")
SHEET_EXTENSIONS = (".xlsx", ".xls", ".numbers")
OLD_SHEET_EXTENSIONS = (".xlsx", ".xls")

MATERIAL_KEYWORDS = (
    ("주교재", "textbook"),
    ("기본서", "textbook"),
    ("부교재", "subtext"),
    ("문제집", "workbook"),
    ("요약", "summary"),
    ("정리본", "summary"),
    ("암기송", "mnemonic"),
    ("생약송", "mnemonic"),
    ("실습송", "mnemonic"),
    ("말만들기", "mnemonic"),
    ("플래시카드", "flashcard"),
    ("스터디", "study-aid"),
    ("정오표", "errata"),
)

# --- page text classes ------------------------------------------------------
MIN_PAGE_CHARS = 60
ODD_FLOOR = 10
ODD_PERCENT = 5
MIN_SCRIPT_CHARS = 20
COMMON_PERCENT = 10

HANGUL = r"\x{AC00}-\x{D7A3}"
COMMON_HANGUL = "이가는은을를에의로와과도만하한할합니다있없되수것들그저때문또는및위해대한따라서약물치료환자투여증상질환경우같다음각첫번"
EXPECTED_CHARS = (
    r"\x{0020}-\x{024F}\x{AC00}-\x{D7A3}\x{4E00}-\x{9FFF}\x{0370}-\x{03FF}"
    r"\x{2000}-\x{22FF}\x{2460}-\x{24FF}\x{3000}-\x{303F}\x{FF00}-\x{FFEF}"
)

# --- page store -------------------------------------------------------------
FRONT_MATTER = r"^---\r?\n[\s\S]*?\r?\n---\r?\n"
FRONT_MATTER_KEYS = (
    "sha", "page", "pages_total", "source_key", "subject_key", "material_type", "extract_route",
)
REQUIRED_KEYS = ("sha", "page", "source_key", "subject_key")
MIN_BODY_CHARS = 40
REFUSAL = r"^(?i:죄송|미안|I'm sorry|I cannot|Sorry)"
ERROR_CHARS = 300
LEAKED_LABELS = (
    "C. 표",
    "A. 흐르는 글 / 목록",
    "B. 다단 조판",
    "D. 도해·회로도 + C. 표 + A. 흐르는 글/목록",
    "B. 다단 조판 + C. 표",
)
BATCH_PRIORITY = (
    "study-guide", "d-grade-list", "textbook", "summary", "subtext", "workbook", "study-aid",
    "mnemonic", "etc",
)

# --- knowledge objects ------------------------------------------------------
SUBJECTS = (
    # folder, key, area, quota, session
    ("1-1. 생화학", "biochemistry", 1, 20, 1),
    ("1-2. 미생물학", "microbiology", 1, 20, 1),
    ("1-3. 약물학", "pharmacology", 1, 20, 1),
    ("1-4. 예방약학", "preventive", 1, 20, 1),
    ("1-5. 병태생리학", "pathophysiology", 1, 20, 1),
    ("2-1. 물리약학", "physical", 2, 18, 2),
    ("2-2. 합성학-의약화학", "medchem", 2, 18, 2),
    ("2-3. 분석학", "analytical", 2, 18, 2),
    ("2-4. 약제학-제제학", "pharmaceutics", 2, 18, 2),
    ("2-5. 생약학-한약제제학", "pharmacognosy", 2, 18, 2),
    ("3-1. 약물치료학", "pharmacotherapy", 3, 77, 3),
    ("3-2. 실무실습", "practice", 3, 27, 4),
    ("3-3. 제조-품질관리학", "manufacturing", 3, 18, 4),
    ("3-4. 사회약학", "social", 3, 18, 4),
    ("4-1. 약사법규", "law", 4, 20, 4),
)
SESSION_TOTALS = {1: 100, 2: 90, 3: 77, 4: 83}
GRAND_TOTAL = 350
ROUNDS = ((71, 2020), (72, 2021), (73, 2022), (74, 2023), (75, 2024), (76, 2025), (77, 2026))
ROUND_IN_NAME = r"제(\d+)회"
SESSION_IN_NAME = r"(\d)교시[ ]*전체[ ]*문제"
CARD_NAME = r"^(\d+)to(\d+)_(?:약치)?([^_\s]+)"
NOTE_SESSION = r"시험지:[ ]*(\d)교시"
NOTE_RANGE = r"문항 범위:[ ]*(\d+)[ ]*~[ ]*(\d+)[ ]*번"
AREA_WORDS = ((r"생명", 1), (r"산업", 2), (r"법규|보건", 4), (r"임상|실무", 3))
OPTION_COUNT = 5
ANSWER_RANGE = (0, 5)
MIN_STEM_CHARS = 3

# --- fidelity ---------------------------------------------------------------
FIGURE_TAG = r"\[FIGURE:[^\]]*\]"
UNREADABLE_TAG = r"\[UNREADABLE\]"
BREAK_TAG = r"(?i)<br[ \t\r\n]*/?>"
MARKUP_CHARS = "[*#`|>_~\\-–—\\[\\]()]"
SHINGLE = 3
MIN_TRUTH_CHARS = 100
MISSED_LIMIT = 12
WORST_LIMIT = 6
RECALL_GATE = 0.85
SAMPLE_ROUNDS = 5
SAMPLE_STRIDE = 7

# --- markup -----------------------------------------------------------------
MARK_ALIASES = {
    "color": "color", "red": "color", "bold": "color", "blue": "color", "green": "color", "c": "color",
    "hl": "hl", "highlight": "hl", "marker": "hl", "h": "hl",
    "underline": "underline", "u": "underline", "ul": "underline",
}
MARKERS = {"color": ("**", "**"), "hl": ("<mark>", "</mark>"), "underline": ("<u>", "</u>")}
COLOR_MARK = r"\*\*([^*\n]+)\*\*"
HL_MARK = r"<mark>([\s\S]*?)</mark>"
UNDERLINE_MARK = r"<u>([\s\S]*?)</u>"
STRIP_ROUNDS = 6
FINGERPRINT_HEX = 32
LINE_OFFSETS = (0, -1, 1, -2, 2)
FAILED_TEXT_CHARS = 60
NONE_HEAVY_REVIEWED = 5
NONE_HEAVY_SHARE = 0.7
CROSSTAB_LIMIT = 25
SAMPLE_PER_DOC = 3
EMPHASIS_PRIORITY = (
    "study-guide", "d-grade-list", "textbook", "summary", "subtext", "workbook", "study-aid",
    "mnemonic", "past-paper", "past-paper-answer", "errata", "etc",
)

# --- pixels and boxes -------------------------------------------------------
CELL = 8
DARK_BELOW = 110
MIN_SATURATION = 0.28
INK_BELOW = 200
HL_FLOOR = 90
INK_CELL, INK_BOX = 6, 40
HL_CELL, HL_BOX = 20, 200
HUE_BOXES = 40
RULE_DARK_BELOW = 130
MIN_WORDS = 15
TALL_SHARE = 0.7

# --- usage and leaks --------------------------------------------------------
PRICE_IN, PRICE_OUT, PRICE_CACHED = "0.20", "1.20", "0.02"   # USD per million tokens
DEFAULT_TAG = "text"
MEAN_IN, MEAN_OUT = 3400, 2500
BULK_LIMIT = 60
BULK_NAME = r"(?i)\.(md|jsonl|json)$"
BULK_ALLOWED = r"^(schema|reports|docs)/"

# --- leak rules (``operators.audit.leak_scan``) ------------------------------
# Id, target column, and the pattern. The ids appear in the output.

LEAK_PATTERNS = (
    ("local-path", "content", r"[A-Za-z]:\\(?:Users|dev)\\"),
    ("api-key", "content", r"\b(?:sk-[A-Za-z0-9_-]{20,}|gho_[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_-]{20,})"),
    ("drive-id", "content", r"\b[A-Za-z0-9_-]{28,44}\b[^\n]*(?:driveFileId|drive_file_id|fileId)"),
    ("study-ext", "path", r"(?i)\.(?:pdf|mp3|m4a|xlsx|goodnotes)\b"),
    ("output-dir", "path", r"^(?:data|render|l1|l2|backups|logs)/"),
    ("l1-content", "content", r"(?m)^---\r?\n(?:[a-z_]+:[^\n]*\r?\n)*?sha:[ \t]*[0-9a-f]{16}\r?\n"),
    ("source-key", "content", r"source_key:[ \t]*[^ \t\r\n]+/[0-9]-[0-9]\."),
)
