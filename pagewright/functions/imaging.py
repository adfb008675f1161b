"""Pixel and colour expressions over r, g, b columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright import fixed_values as V


def brightness(r: Column, g: Column, b: Column) -> Column:
    return F.greatest(r, g, b)


def saturation(r: Column, g: Column, b: Column) -> Column:
    top = F.greatest(r, g, b)
    return F.when(top == 0, 0.0).otherwise((top - F.least(r, g, b)) / F.nullif(top, F.lit(0)))


def pixel_class(r: Column, g: Column, b: Column) -> Column:
    """dark, ink, hl or none."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    return (
        F.when(top < V.DARK_BELOW, "dark")
        .when(saturation(r, g, b) < V.MIN_SATURATION, "none")
        .when(top < V.INK_BELOW, "ink")
        .when(low > V.HL_FLOOR, "hl")
        .otherwise("none")
    )


def hue_name(r: Column, g: Column, b: Column) -> Column:
    """Name of a mean colour."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    warm = (
        F.when(g > low + (top - low) * 0.55, "orange").when(b > g + 25, "pink").otherwise("red")
    )
    return (
        F.when(top - low < 30, "gray")
        .when(r == top, warm)
        .when(g == top, "green")
        .when((b > 150) & (r > 110), "purple")
        .otherwise("blue")
    )


def round_half_up(x: Column) -> Column:
    return F.floor(x + 0.5).cast("int")


def text_shaped(w: Column, h: Column, px: Column) -> Column:
    """A box as high as a line of text and not too narrow."""
    return (h >= 10) & (h <= 64) & (w * 10 >= h * 6) & (px >= 60)


def emphasis_level(text_ink: Column, text_hl: Column) -> Column:
    return (
        F.when((text_ink >= 3) | (text_hl >= 2), "strong")
        .when((text_ink >= 1) | (text_hl >= 1), "weak")
        .otherwise("none")
    )
