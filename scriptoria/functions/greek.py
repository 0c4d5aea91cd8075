"""Beta Code and Greek letters on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters of Beta Code and of Greek in the order of the Greek alphabet, and the combining marks of
# smooth and rough breathing, acute, grave, circumflex, diaeresis and iota subscript.
BETA, GREEK = "abgdezhqiklmncoprstufxyw", "αβγδεζηθικλμνξοπρστυφχψω"
MARKS, COMBINING = ")(/\\=+|", "̓̔́̀͂̈ͅ"


def beta_to_greek(text: Column, final: bool = True) -> Column:
    """Greek letters with combining marks; * before a letter (and its marks) makes it a capital. final: sigma at a word's end has its own form.

    Characters that Beta Code does not use stay as they are; null stays null.
    """
    moved = F.regexp_replace(F.lower(text), r"\*([)(/\\=+|]*)([a-z])", "*$2$1")
    capitals = F.transform(F.split(moved, r"\*"), lambda part, k: F.when(k > 0, F.concat(F.upper(F.substring(part, 1, 1)), F.substring(part, 2, 1 << 30))).otherwise(part))
    out = F.translate(F.array_join(capitals, ""), BETA + BETA.upper() + MARKS, GREEK + GREEK.upper() + COMBINING)
    return F.regexp_replace(out, r"σ(?![\p{L}\p{M}])", "ς") if final else out


def greek_to_beta(text: Column) -> Column:
    """Beta Code of Greek letters with combining marks; a capital is * and the letter, its marks between them."""
    plain = F.replace(text, F.lit("ς"), F.lit("σ"))
    out = F.translate(plain, GREEK + GREEK.upper() + COMBINING, BETA + BETA.upper() + MARKS)
    return F.lower(F.regexp_replace(out, r"([A-Z])([)(/\\=+|]*)", r"*$2$1"))


def encoding(text: Column) -> Column:
    """unicode if there are Greek letters, beta if ASCII letters carry Beta Code's marks, else plain; null of null."""
    return F.when(F.rlike(text, F.lit(r"\p{IsGreek}")), "unicode").when(F.rlike(text, F.lit(r"[A-Za-z][)(/\\=|+]|\*[)(/\\=|]*[A-Za-z]")), "beta").when(text.isNotNull(), "plain")
