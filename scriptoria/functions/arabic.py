"""Arabic on columns: three transliterations, Arabic letters, lookup and bare forms.

A word is written in Buckwalter's letters, in the dictionary's spelling (two characters for hamza on a
carrier, madda and long initial i), or in Buckwalter's with three letters for the characters that markup
reserves. Unknown characters stay as they are; null stays null; empty stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Buckwalter's letters and the Arabic ones, in the same order: letters, tatweel, vowels and marks, Persian letters.
BUCKWALTER = "'|>&<}AbptvjHxd*rzs$SDTZEg_fqklmnhwYyFNKaui~o`{PJVG"
ARABIC = "ءآأؤإئابةتثجحخدذرزسشصضطظعغـفقكلمنهوىيًٌٍَُِّْٰٱپچڤگ"
# The dictionary's spelling of letters that Buckwalter writes otherwise, and the letters that stand for reserved characters.
DICTIONARY = {"A^": ">", "y^": "}", "w^": "&", "A=": "|", "A_": "<i"}
RESERVED, FRIENDLY = "&<>", "WIO"
# Vowels, tanween, shadda and sukun.
MARKS = "~FNKauio"


def transliterated(text: Column, pairs: dict[str, str]) -> Column:
    """text with each key of pairs replaced, read once from the left; of several keys that begin in a place the longest is taken."""
    keys = sorted(pairs, key=lambda k: (-len(k), k))
    pattern = "(?s)" + "|".join([*("\\Q" + k + "\\E" for k in keys), "."])
    known = F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.coalesce(F.try_element_at(known, x), x)), "")


def from_dictionary(text: Column) -> Column:
    """Buckwalter's letters of a word in the dictionary's spelling."""
    return transliterated(text, DICTIONARY)


def to_dictionary(text: Column) -> Column:
    """The dictionary's spelling of a word in Buckwalter's letters; < without i has none and stays."""
    return transliterated(text, {v: k for k, v in DICTIONARY.items()})


def friendly(text: Column) -> Column:
    """Buckwalter's letters without characters that markup reserves."""
    return F.translate(text, RESERVED, FRIENDLY)


def unfriendly(text: Column) -> Column:
    return F.translate(text, FRIENDLY, RESERVED)


def to_arabic(text: Column) -> Column:
    """Arabic letters of a word in any of the three transliterations."""
    return F.translate(unfriendly(from_dictionary(text)), BUCKWALTER, ARABIC)


def from_arabic(text: Column) -> Column:
    """Buckwalter's letters, those of markup, of Arabic ones."""
    return friendly(F.translate(text, ARABIC, BUCKWALTER))


def unvowelled(text: Column) -> Column:
    """A transliterated word without vowels and marks."""
    return F.translate(text, MARKS, "")


def lookup(text: Column) -> Column:
    """The form by which a parse table knows a word of any alphabet: Buckwalter's letters, those of markup, without shadda."""
    return from_arabic(F.translate(friendly(from_dictionary(text)), "~ّ", ""))
