"""Positional morphology codes, one character a category, and the features that they stand for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_PERSON = {"1": "1st", "2": "2nd", "3": "3rd"}
_GENDER = {"m": "masc", "f": "fem", "n": "neut"}
_CASE = {"n": "nom", "g": "gen", "d": "dat", "a": "acc", "b": "abl", "v": "voc", "l": "loc", "i": "ins"}
_DEGREE = {"c": "comp", "s": "superl"}
# The persons that an Arabic affix stands for, in the order of their characters.
_AFFIXED = ["1st/plur", "1st/sing", "2nd/dual", "2nd/fem/plur", "2nd/fem/sing", "2nd/masc/plur", "2nd/masc/sing", "3rd/dual", "3rd/fem/plur", "3rd/fem/sing", "3rd/masc/plur", "3rd/masc/sing"]


def _owners(form: str, characters: str) -> dict[str, str]:
    return {c: form % who for c, who in zip(characters, _AFFIXED)}


# The categories in their order, and each character's feature.
CODES: dict[str, dict[str, dict[str, str]]] = {
    "grc": {
        "pos": {"n": "noun", "v": "verb", "t": "part", "a": "adj", "d": "adv", "l": "article", "g": "partic", "c": "conj", "r": "prep", "p": "pron", "m": "numeral", "i": "interj", "e": "exclam", "x": "irreg"},
        "person": _PERSON,
        "number": {"s": "sg", "p": "pl", "d": "dual"},
        "tense": {"p": "pres", "i": "imperf", "r": "perf", "l": "plup", "t": "futperf", "f": "fut", "a": "aor"},
        "mood": {"i": "ind", "s": "subj", "o": "opt", "n": "inf", "m": "imperat", "p": "part", "g": "gerundive"},
        "voice": {"a": "act", "p": "pass", "d": "dep", "m": "mid", "e": "mp"},
        "gender": _GENDER,
        "case": _CASE,
        "degree": _DEGREE,
    },
    "la": {
        "pos": {"n": "noun", "v": "verb", "t": "part", "a": "adj", "d": "adv", "c": "conj", "r": "prep", "p": "pron", "m": "numeral", "i": "interj", "e": "exclam"},
        "person": _PERSON,
        "number": {"s": "sg", "p": "pl"},
        "tense": {"p": "pres", "i": "imperf", "r": "perf", "l": "plup", "t": "futperf", "f": "fut"},
        "mood": {"i": "ind", "s": "subj", "n": "inf", "m": "imperat", "p": "part", "g": "gerundive", "u": "supine", "d": "gerund"},
        "voice": {"a": "act", "p": "pass", "d": "dep", "e": "mp"},
        "gender": _GENDER,
        "case": _CASE,
        "degree": _DEGREE,
    },
    "ang": {
        "pos": {"n": "noun", "v": "verb", "t": "part", "a": "adj", "d": "adv", "c": "conj", "r": "prep", "p": "pron", "m": "numeral", "i": "interj", "e": "exclam"},
        "person": _PERSON,
        "number": {"s": "sg", "p": "pl", "d": "dual"},
        "tense": {"p": "pres", "i": "imperf", "r": "perf", "l": "plup", "t": "futperf", "f": "fut", "a": "aor"},
        "mood": {"i": "ind", "s": "subj", "n": "inf", "m": "imperat", "g": "gerundive"},
        "voice": {"a": "act", "p": "pass", "d": "dep", "e": "mp"},
        "gender": _GENDER,
        "case": _CASE,
        "degree": {"p": "pos", "c": "comp", "s": "superl"},
    },
    "non": {
        "pos": {"n": "noun", "v": "verb", "a": "adj", "d": "adv", "c": "conj", "r": "prep", "p": "pron", "i": "interj", "e": "exclam"},
        "person": _PERSON,
        "number": {"s": "sg", "p": "pl", "d": "dual"},
        "tense": {"p": "pres", "r": "pastabs", "l": "plup", "t": "futperf", "f": "fut"},
        "mood": {"i": "ind", "s": "subj", "n": "inf", "m": "imperat", "p": "part"},
        "voice": {"a": "act", "p": "pass", "e": "mp"},
        "gender": _GENDER,
        "case": _CASE,
        "degree": _DEGREE,
    },
    # Affixes have places of their own: what a noun belongs to, its article, a verb's object, and what is written before the word.
    "ar": {
        "pos": {"n": "noun", "v": "verb", "t": "part", "a": "adj", "d": "adv", "c": "conj", "g": "partic", "r": "prep", "p": "pron", "m": "numeral", "i": "interj", "e": "exclam", "f": "func"},
        "person": _PERSON,
        "number": {"s": "sg", "p": "pl", "d": "dual"},
        "tense": {"p": "pres", "i": "imperf", "r": "perf", "l": "plup", "t": "futperf", "f": "fut"},
        "mood": {"i": "ind", "s": "subj", "n": "inf", "m": "imperat", "p": "part", "g": "gerundive", "u": "supine"},
        "voice": {"a": "act", "p": "pass", "d": "dep", "e": "mp"},
        "gender": _GENDER,
        "case": _CASE,
        "degree": _DEGREE,
        "possessive": {"p": "possessive", **_owners("poss(%s)", "abcdefghijkm")},
        "definite": {"d": "definite", "i": "indefinite"},
        "object": _owners("+obj(%s)", "abcdefghijkl"),
        "prefix": {"c": "conj+", "e": "emphatic+", "p": "prep+", "r": "resultative+", "i": "interrogative+", "n": "neg+"},
    },
}


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), key)


def code_features(code: Column, language: str) -> Column:
    """Map of category to feature for the characters a code sets; unknown characters set nothing."""
    each = [F.struct(F.lit(name).alias("key"), _lookup(values, F.substring(code, k, 1)).alias("value")) for k, (name, values) in enumerate(CODES[language].items(), 1)]
    return F.when(code.isNotNull(), F.map_from_entries(F.filter(F.array(*each), lambda e: e["value"].isNotNull())))


def features_code(features: Column, language: str) -> Column:
    """The code of a map of features: - where a category is not set, ! for a feature without a character."""
    out = []
    for name, values in CODES[language].items():
        feature = F.try_element_at(features, F.lit(name))
        out.append(F.when(feature.isNull(), "-").otherwise(F.coalesce(_lookup({v: c for c, v in values.items()}, feature), F.lit("!"))))
    return F.when(features.isNotNull(), F.concat(*out))


def compound_features(prefixes: Column, stem: Column, suffixes: Column) -> Column:
    """One map of the features of a word's parts, each a map of category to feature; the stem's own features win, then the suffixes'.

    Parts that are null add nothing; a word of which every part is null has none (null).
    """
    none = F.create_map().cast("map<string,string>")
    own, after, before = (F.coalesce(p, none) for p in (stem, suffixes, prefixes))
    new = lambda part, *others: F.map_filter(part, lambda k, _: reduce(Column.__and__, (~F.map_contains_key(o, k) for o in others)))
    return F.when(F.coalesce(prefixes, stem, suffixes).isNotNull(), F.map_concat(own, new(after, own), new(before, own, after)))
