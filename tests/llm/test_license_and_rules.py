import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import license_scan, quality_rules


def test_license_edges(spark, odd, nothing):
    rows = {r["doc_id"]: r for r in license_scan.license_scan(odd).collect()}
    assert rows[1]["n_words"] == 0 and rows[1]["labels"] == "" and rows[1]["first_word"] is None
    assert rows[9]["base_labels"] == "mit" and rows[9]["first_word"] == 3 and rows[9]["score"] == 1.0
    assert license_scan.license_scan(nothing).count() == 0


def test_license_places_and_thresholds(spark):
    grant = "permission is hereby granted free of charge to any person obtaining a copy of this software"
    partly = " ".join(w for w in grant.split() if w not in ("charge", "copy"))
    low = " ".join(grant.split()[:9])
    rows = [
        (1, "MIT License mit license, MIT-license"), (2, grant), (3, "x " * 70 + partly), (4, low), (5, "K mit licenKe"),
        (6, "GNU General Public License; CC BY"), (7, "the mitİ license"),
    ]
    out = {r["doc_id"]: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (out[1]["n_base"], out[1]["first_word"], out[1]["last_word"]) == (3, 0, 4)
    assert out[2]["labels"] == "mit" and out[2]["score"] == 1.0 and out[2]["base_labels"] == ""
    assert out[3]["labels"] == "mit" and out[3]["score"] == pytest.approx(13 / 15)  # distinct tokens
    assert out[4]["labels"] == "" and out[4]["score"] == 0.0
    assert out[5]["n_base"] == 0 and out[5]["n_words"] == 3
    assert out[6]["base_labels"] == "cc-by,gpl" and (out[6]["first_word"], out[6]["last_word"]) == (0, 4)
    assert out[7]["n_base"] == 0


def test_kindred_licenses_are_told_apart(spark):
    """Each notice gets its own label, and none of its kin's."""
    texts = {
        "licensed under the GNU General Public License version 3": "gpl,gpl-3.0", "Licensed under the GNU Affero General Public License, version 3": "agpl",
        "licensed under the GNU Lesser General Public License": "lgpl", "Licensed under CC BY 4.0": "cc-by,cc-by-4.0",
        "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc-4.0", "Licensed under CC BY-SA 4.0": "cc-by,cc-by-sa-4.0", "licensed under cc by-nc-sa 4.0": "cc-by",
        "license version 3 of the gnu general public, licensed under": "",
    }
    rows = [(k, f"{'z ' * pad}{text} and so on") for k, text in enumerate(texts) for pad in (0, 40, 90)]
    out = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = list(texts.values())
    assert all(r["labels"] == want[r["doc_id"]] for r in out) and len(out) == len(rows)


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {p for starts in windows.values() if len(starts) > 1 for s in starts for p in range(s, s + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
    )


def test_statistics_against_plain_python(documents, odd):
    for frame in (documents, odd):
        texts = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
        rows = quality_rules.quality_rules(frame).collect()
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        ours = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows), key=key)
        assert ours == sorted(((i, *plain_statistics(t)) for i, t in texts), key=key)
        for r in rows:
            assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
            assert not (r["base_failed"] and r["kept"])


def test_rules_of_an_empty_table(nothing):
    assert quality_rules.quality_rules(nothing).count() == 0


def test_distances_against_numpy(spark):
    """The concentration steps, repeated with numpy on one group with far outliers."""
    rng = np.random.default_rng(3)
    p = len(quality_rules.VECTOR)
    clean = rng.multivariate_normal(np.full(p, 4000), np.eye(p) * 250_000 + 120_000, 400)
    points = np.rint(np.vstack([clean, clean[:40] + 30_000])).astype(int)
    rows = [(i, "en", "a", *map(int, x)) for i, x in enumerate(points)]
    frame = spark.createDataFrame(rows, "row long, lang string, source string, " + ", ".join(f"{v} long" for v in quality_rules.VECTOR))
    ours = np.array([r["d2"] for r in quality_rules.robust_distances(frame, 0.75, 4).orderBy("row").collect()])
    floors = np.diag((np.array(quality_rules.FLOORS) * quality_rules.UNIT) ** 2)
    n = len(points)
    ends = []
    for centre, spread in (
        (np.array([np.sort(points[:, k])[int(np.ceil(0.5 * n)) - 1] for k in range(p)], float), floors),
        (points.mean(axis=0), np.cov(points.T, bias=True) + floors),
    ):
        for step in range(5):
            z = points - centre
            d2 = np.einsum("ij,jk,ik->i", z, np.linalg.inv(spread), z)
            bins = np.floor(np.log2(1 + d2) * quality_rules.DISTANCE_BINS)
            if step < 4:
                inner = points[bins <= np.sort(bins)[int(np.ceil(0.75 * n)) - 1]]
                centre, spread = inner.mean(axis=0), np.cov(inner.T, bias=True) + floors
        ends.append((np.linalg.slogdet(spread)[1], d2, bins))
    _, d2, bins = min(ends, key=lambda e: e[0])
    middle = 2 ** (np.sort(bins)[int(np.ceil(0.5 * n)) - 1] / quality_rules.DISTANCE_BINS) - 1
    assert ours == pytest.approx(d2 / max(middle / quality_rules.CHI2_MEDIAN, 1), rel=1e-6)
    assert (ours[400:] > 60).all() and (ours[:400] < 60).all()


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    p = len(quality_rules.VECTOR)
    return lambda n, shift=0: np.rint(rng.multivariate_normal(np.full(p, 4000 + shift), np.eye(p) * 250_000, n)).astype(int)


def distances_of(spark, groups):
    rows = [(lang, source, *map(int, x)) for lang, source, points in groups for x in points]
    schema = "row long, lang string, source string, " + ", ".join(f"{v} long" for v in quality_rules.VECTOR)
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    found = {r["row"]: r["d2"] for r in quality_rules.robust_distances(frame).collect()}
    out, at = [], 0
    for _, _, points in groups:
        out.append(np.array([found[at + i] for i in range(len(points))]))
        at += len(points)
    return out


def test_no_group_size_switches_the_rule(spark, vectors):
    """Groups of one kind with one row more or less, null names among them, are judged alike; a few far rows in a group of their own are not kept."""
    sizes = [24, 25, 49, 50, 51, 99, 100]
    far = vectors(100, 9000)
    groups = [("en", None, vectors(600)), (None, "a", vectors(60)), ("en", "two", vectors(2, 30_000)), ("en", "", vectors(1))]
    found = distances_of(spark, groups + [("en", f"s{n}", far[:n]) for n in sizes])
    assert (found[0] < quality_rules.CHI2_CUTOFF).all() and (found[1] < quality_rules.CHI2_CUTOFF).all() and found[3][0] < quality_rules.CHI2_CUTOFF
    assert (found[2] > quality_rules.CHI2_CUTOFF).all()
    shares = [float((d > quality_rules.CHI2_CUTOFF).mean()) for d in found[4:]]
    assert max(shares) - min(shares) < 0.05
    typical = [float(np.median(d)) for d in found[4:]]
    assert all(0.8 < a / b < 1.25 for (a, b), (m, n) in zip(zip(typical, typical[1:]), zip(sizes, sizes[1:])) if n - m == 1)


def test_junk_is_rejected_and_clean_kept(spark, folder, documents):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = quality_rules.quality_rules(documents).join(labels, "doc_id")
    good = judged.filter("quality = 1 AND n_words >= 20").agg(F.avg(F.col("kept").cast("double"))).first()[0]
    assert good > 0.98


def test_single_bad_shares_are_rejected(spark):
    """One bad share is enough: a symbol after every word, or nothing but one line again and again."""
    rng = np.random.default_rng(8)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    lines = [[" ".join(rng.choice(words, 6)) for _ in range(rng.integers(5, 30))] for _ in range(300)]
    rows = [(i, "\n".join(x), "en", "a") for i, x in enumerate(lines)]
    rows += [(1000 + i, " | ".join(" ".join(x).split()), "en", "a") for i, x in enumerate(lines[:10])]
    rows += [(2000 + i, "\n".join(["wa wb wc"] * 2 + [x[0]] + ["wa wb wc"] * 2 + [x[1]] + ["wd we"] * 3 + [x[2]]), "en", "a") for i, x in enumerate(lines[:10])]
    out = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(out[i]["base_failed"] for i in out)
    assert not any(r["kept"] for i, r in out.items() if i >= 1000)
    assert sum(r["kept"] for i, r in out.items() if i < 1000) > 0.98 * len(lines)
