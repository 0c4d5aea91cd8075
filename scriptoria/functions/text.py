"""Text functions on columns: word patterns, folding, names, escapes and citation paths."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accented vowels and their plain letters, by position; ligatures become two letters.
ACCENTED = "àáâãäåāăąèéêëēĕėęěìíîïĩīĭįòóôõöøōŏőùúûüũūŭůűųýÿŷÀÁÂÃÄÅĀĂĄÈÉÊËĒĔĖĘĚÌÍÎÏĨĪĬĮÒÓÔÕÖØŌŎŐÙÚÛÜŨŪŬŮŰŲÝŸŶ"
PLAIN = "aaaaaaaaaeeeeeeeeeiiiiiiiiooooooooouuuuuuuuuuyyyAAAAAAAAAEEEEEEEEEIIIIIIIIOOOOOOOOOUUUUUUUUUUYYY"
MACRONS, WITHOUT = "āēīōūĀĒĪŌŪ", "aeiouAEIOU"
#: Word patterns by language; others take the default, which is ASCII only.
WORDS = {"default": r"[A-Za-z][A-Za-z\[\]]*", "unicode": r"\p{L}+", "la": r"[A-Za-zāēīōūĀĒĪŌŪ]+", "ang": r"[A-Za-zæðþÆÐÞāēīōūǣȳĀĒĪŌŪǢȲ]+", "non": r"[A-Za-zæœøþðáéíóúýöÆŒØÞÐÁÉÍÓÚÝÖ]+", "ar": r"[A-Za-z'`{}|<>&~$*_-]+", "grc": r"[*A-Za-z()/\\=|+']+"}


def running_starts(rows: DataFrame, lengths: str, name: str) -> DataFrame:
    """rows with name: for each entry of an array of lengths, the sum of those before it.

    Sums go over blocks of about the root of the array's size, so that long arrays cost little and
    no row leaves its task.
    """
    zero = F.lit(0).cast("long")

    def total(array: Column) -> Column:
        return F.aggregate(array, zero, lambda acc, x: acc + x)

    n = F.size(lengths)
    size = F.greatest(F.ceil(F.sqrt(n)), F.lit(1)).cast("int")
    blocks = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int"))).otherwise(F.array().cast("array<int>"))
    sums = F.transform(blocks, lambda b: total(F.slice(lengths, b * size + 1, size)))
    heads = F.transform(blocks, lambda b: total(F.slice(sums, F.lit(1), b)))
    # The heads are an argument, not a column that the function reads: that would be worked out anew for each entry.
    pairs = F.arrays_zip(blocks.alias("b"), heads.alias("head"))
    inner = lambda z: F.transform(F.sequence(F.lit(0), F.least(size, n - z["b"] * size) - 1), lambda k: z["head"] + total(F.slice(lengths, z["b"] * size + 1, k)))
    return rows.withColumn(name, F.flatten(F.transform(pairs, inner)))


def words(text: Column, language: str = "default") -> Column:
    """The words of a text in order; character entities are not words. Null gives null."""
    return F.regexp_extract_all(F.regexp_replace(text, r"[&_][A-Za-z]+;", " "), F.lit(WORDS.get(language, WORDS["default"])), F.lit(0))


def holds_word(text: Column, language: str = "default") -> Column:
    """Whether words() of a text has any; null for null."""
    return F.rlike(F.regexp_replace(text, r"[&_][A-Za-z]+;", " "), F.lit(WORDS.get(language, WORDS["default"])))


def deaccent(text: Column) -> Column:
    out = F.translate(text, ACCENTED, PLAIN)
    for old, new in (("æ", "ae"), ("œ", "oe"), ("Æ", "AE"), ("Œ", "OE")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def drop_macrons(text: Column) -> Column:
    return F.translate(text, MACRONS, WITHOUT)


def bare_form(text: Column) -> Column:
    """A Beta Code form without breathings, accents, capitals' marks and apostrophes."""
    return F.regexp_replace(text, r"[()\\/*=|+']", "")


def greek_lookup(text: Column) -> Column:
    """Grave to acute, only the first acute or circumflex kept, brackets dropped."""
    out = F.regexp_replace(F.translate(text, "\\", "/"), r"[\[\]]", "")
    return F.regexp_replace(out, r"^([^/=]*[/=][^/=]*)[/=](.*)$", "$1$2")


def greek_unaccented(text: Column) -> Column:
    return F.regexp_replace(text, r"[/\\=]", "")


def arabic_bare(text: Column) -> Column:
    """Buckwalter text without short vowels, tanween, shadda and sukun."""
    return F.regexp_replace(text, r"[aiuoFKN~`]", "")


def capitalised_name(name: Column) -> Column:
    """Words with a capital each, and after Mc, Mac (of longer words) and O'."""
    low = F.lower(name)
    each = F.transform(
        F.split(low, " "),
        lambda w: F.when(F.rlike(w, F.lit("^mc.")), F.concat(F.lit("Mc"), F.initcap(F.substring(w, 3, 99))))
        .when(F.rlike(w, F.lit("^mac.{3,}")), F.concat(F.lit("Mac"), F.initcap(F.substring(w, 4, 99))))
        .when(F.rlike(w, F.lit("^o'.")), F.concat(F.lit("O'"), F.initcap(F.substring(w, 3, 99))))
        .otherwise(F.initcap(w)),
    )
    return F.array_join(each, " ")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def join_present(separator: str, *columns: Column) -> Column:
    """The columns that are neither null nor empty, joined."""
    return F.concat_ws(separator, *(F.nullif(c, F.lit("")) for c in columns))


def no_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def xml_escaped(text: Column) -> Column:
    pairs = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def xml_unescaped(text: Column) -> Column:
    pairs = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def sql_escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))


def without_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, r"<[^>]+>", "")


def lemma_parts(text: Column) -> tuple[Column, Column]:
    """Headword and sequence number of a lemma such as word2; without one the number is null."""
    number = F.try_to_number(F.nullif(F.regexp_extract(text, r"^(\D+)(\d+)$", 2), F.lit("")), F.lit("999999999")).cast("int")
    return F.when(number.isNotNull(), F.regexp_extract(text, r"^(\D+)(\d+)$", 1)).otherwise(text), number


def short_definition(text: Column, most: int = 100) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common beginning of two strings."""
    steps = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)))
    return F.array_max(F.filter(steps, lambda k: F.substring(a, F.lit(1), k) == F.substring(b, F.lit(1), k)))


def _rows(a: Column, b: Column, first: float, border: float, cell) -> Column:
    """Last cell of an alignment table of a against b, folded row by row over b's characters; null if either is."""
    start = F.transform(F.sequence(F.lit(0), F.length(a)), lambda k: F.lit(first) + k * F.lit(border))

    def row(above: Column, j: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            return F.concat(acc, F.array(cell(F.element_at(above, i), F.element_at(above, i + 1), F.element_at(acc, -1), F.substring(a, i, F.lit(1)) == F.substring(b, j, F.lit(1)))))

        head = F.array(F.element_at(above, 1) + F.lit(border))
        return F.when(F.length(a) == 0, head).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), head, step))

    last = F.element_at(F.when(F.length(b) == 0, start).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(b), F.lit(1))), start, row)), -1)
    return F.when(a.isNotNull() & b.isNotNull(), last)


def similarity_score(a: Column, b: Column) -> Column:
    """Best alignment: 1 for each matched character, 0 for two that differ, 0.05 less for each gap."""
    return _rows(a, b, 0.0, -0.05, lambda d, u, l, same: F.greatest(F.when(same, d + 1.0).otherwise(d), u - 0.05, l - 0.05))


def vocalisation_score(a: Column, b: Column) -> Column:
    """1 over an edit distance (insert or delete 1, replace 2, free borders); 1 over 0.0001 if equal."""
    d = _rows(a, b, 0.0, 0.0, lambda d, u, l, same: F.least(F.when(same, d).otherwise(d + 2.0), u + 1.0, l + 1.0))
    return 1.0 / F.when(d == 0, 0.0001).otherwise(d)


def person_names(surname: Column, forename: Column) -> tuple[Column, Column]:
    """Authority name (surname, forename; lower case) and display name (forename surname)."""
    return F.lower(join_present(",", surname, forename)), join_present(" ", forename, surname)


def place_parts(name: Column) -> tuple[Column, Column, Column]:
    """City, state and nation of names like City (State, Nation), City (Nation) or City, State."""
    inside = F.regexp_extract(name, r"\(([^)]*)\)", 1)
    city = F.trim(F.regexp_extract(name, r"^([^(,]*)", 1))
    state = F.when(inside.contains(","), F.trim(F.split_part(inside, F.lit(","), F.lit(1)))).when((inside == "") & name.contains(","), F.trim(F.split_part(name, F.lit(","), F.lit(2))))
    nation = F.when(inside.contains(","), F.trim(F.split_part(inside, F.lit(","), F.lit(2)))).when(inside != "", F.trim(inside))
    return city, state, nation


def path_steps(citation: Column) -> Column:
    """Steps (type, value) of a citation such as System:kind:id:book=1:line=2."""
    return F.transform(F.filter(F.split(citation, ":"), lambda s: s.contains("=")), lambda s: F.struct(F.split_part(s, F.lit("="), F.lit(1)).alias("type"), F.split_part(s, F.lit("="), F.lit(2)).alias("value")))


def path_document(citation: Column) -> Column:
    return F.array_join(F.filter(F.split(citation, ":"), lambda s: ~s.contains("=")), ":")


def path_parent(citation: Column) -> Column:
    """The citation without its last step; one without steps is its own."""
    parts = F.split(citation, ":")
    return F.when(F.element_at(parts, -1).contains("="), F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), ":")).otherwise(citation)


def path_string(document: Column, steps: Column) -> Column:
    return F.concat_ws(":", document, F.array_join(F.transform(steps, lambda s: F.concat_ws("=", s["type"], s["value"])), ":"))


def document_of_urn(urn: Column, system: str) -> Column:
    """System:kind:id of urn:cts:collection:group.work.edition:passage; null for other strings."""
    parts = F.split(urn, ":")
    return F.when(F.startswith(urn, F.lit("urn:cts:")) & (F.size(parts) >= 4), F.concat_ws(":", F.lit(system), F.element_at(parts, 3), F.try_element_at(parts, F.lit(4))))


def default_types(scheme: Column) -> Column:
    """Types of a scheme such as book:chapter*:section, without the default's mark."""
    return F.split(F.replace(scheme, F.lit("*"), F.lit("")), ":")


def default_type(scheme: Column) -> Column:
    """The marked type of a scheme, else the last."""
    parts = F.split(scheme, ":")
    marked = F.filter(parts, lambda p: F.endswith(p, F.lit("*")))
    return F.replace(F.coalesce(F.try_element_at(marked, F.lit(1)), F.element_at(parts, -1)), F.lit("*"), F.lit(""))


def sort_name(name: Column) -> Column:
    """Last name first: what follows a comma and what is in brackets goes; last word, then the rest."""
    kept = F.split(F.trim(F.regexp_replace(F.regexp_replace(name, r"\([^)]*\)", ""), r",.*$", "")), " +")
    return F.lower(F.array_join(F.concat(F.array(F.element_at(kept, -1)), F.slice(kept, F.lit(1), F.size(kept) - 1)), " "))


def sort_title(title: Column) -> Column:
    return F.lower(F.regexp_replace(title, r"^(A|An|The|Le|Les|La|Die|Il) ", ""))


def sort_value(*keys: Column) -> Column:
    """The first key that is there, else one that sorts last."""
    return F.coalesce(*keys, F.lit("zzzzzzz"))


def morphology_link(form: Column, language: Column) -> Column:
    """An anchor that asks for the parses of a form."""
    return F.concat(F.lit('<a href="morph?l='), xml_escaped(F.lower(form)), F.lit("&amp;la="), language, F.lit('">'), form, F.lit("</a>"))


# Periods as museums name them, and the period that each is sorted under.
PERIODS = {
    "Middle Bronze Age": "MBA", "Late Bronze Age": "LBA", "Dark Age": "Dark Age", "Geometric": "Geom", "Geom./Arch./Clas.": "Geom/Arch/Clas",
    "Archaic": "Archaic", "Early Archaic": "Archaic", "High Archaic": "Archaic", "-500": "Archaic", "Late Archaic": "Late Archaic",
    "Late Arch./Early Clas.": "L. Arch/Early Clas.", "Archaic/Classical": "Arch/Clas", "Archaic - Hellenistic": "Arch. - Hell.", "Early Classical": "Early Clas.",
    "Classical": "Classical", "Late Archaic/Early Classical": "Classical", "Classical/Late Class.": "Clas/Late Clas.", "High Classical": "High Classical",
    "Late Classical": "Late Classical", "Late Classical/Early Hellenistic": "Late Classical", "Late Classical/Hellenistic": "Late Clas./Hell.", "Late Clas./Hell.": "Late Clas/Hell.",
    "Early Hellenistic": "Early Hellenistic", "Hellenistic": "Hell.", "High Hellenistic": "Hell.", "Late Hellenistic": "Late Hell.",
    "Graeco-Roman": "Hell./Roman", "Hellenistic/Roman": "Hell./Roman", "Roman": "Roman", "Roman?": "Roman",
    "Late Etruscan/Republican": "Etruscan/Republican", "Late Republican": "Etruscan/Republican", "Republican": "Etruscan/Republican", "Roman Imperial": "Roman Imperial",
    "Augustan": "Augustan", "Augustan/Julio-Claudian": "Augustan", "Julio-Claudian": "Julio-Claudian", "Julio-Claudian or Hadrianic": "Julio-Claudian", "Julio-Claudian/Flavian": "Julio-Claudian",
    "Flavian": "Flavian", "Late Flavian/Trajanic": "Flavian", "Flavian-Antonine?": "Nerva", "Nerva": "Nerva", "Trajanic": "Trajanic", "Trajanic/Hadrianic": "Trajanic", "Trajanic?": "Trajanic",
    "Hadrianic": "Hadrianic", "Antonine": "Antonine", "Late Antonine/Severan": "Antonine", "Severan": "Severan", "Severan?": "Severan", "Third Century A.C.": "Third Century A.C.",
    "Late Roman Imperial": "Late Roman", "Late Roman Imperial/Early Byzantine": "Late Roman", "Tetrarchic": "Tetrarchic", "Constantinian": "Constantinian",
    "Early Byzantine": "Early Byzantine", "Chrisitan": "Early Byzantine", "Modern": "Modern",
}


def sortable_period(period: Column) -> Column:
    """The period that a museum's name of one is sorted under; null for other names."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in PERIODS.items() for x in pair)), period)
