"""Parses (form, lemma, code): lookups with fallback, votes on them, and scores that choose among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions.text import words
from scriptoria.sources.tables import kept, small


def told_by(words: DataFrame, parses: DataFrame, lexicon: DataFrame) -> DataFrame:
    """words(word) with told_by: parse where the parse table has the form, lemma where only the lexicon has it, else form."""
    hit = parses.select(F.col("form").alias("word")).distinct().withColumn("_p", F.lit(True))
    head = lexicon.select(F.col("lemma").alias("word")).distinct().withColumn("_l", F.lit(True))
    rows = words.join(small(hit), "word", "left").join(small(head), "word", "left")
    return rows.withColumn("told_by", F.when(F.col("_p"), "parse").when(F.col("_l"), "lemma").otherwise("form")).drop("_p", "_l")


def grouped(parses: DataFrame) -> DataFrame:
    """(form, lemma, codes): the sorted codes of each lemma of a form."""
    return parses.groupBy("form", "lemma").agg(F.array_sort(F.collect_set("code")).alias("codes"))


def forms_of(parses: DataFrame, words: list[str]) -> DataFrame:
    """Distinct forms of all lemmas that the words may be forms of."""
    lemmas = parses.where(F.col("form").isin(words)).select("lemma").distinct()
    return parses.join(small(lemmas), "lemma", "left_semi").select("form").distinct()


def lexicon_index(lexicon: DataFrame) -> DataFrame:
    """Headwords with what a search by end, an order and a length filter read: reversed text, size and first letter."""
    return lexicon.select("lemma", F.reverse("lemma").alias("reversed"), F.length("lemma").cast("long").alias("size"), F.substring("lemma", 1, 1).alias("head"))


def votes_on(parses: DataFrame, votes: DataFrame) -> DataFrame:
    """parses(lemma, code, sequence) with their votes; those without any have 0. Votes for no known parse, or without a code, are left out."""
    counts = votes.where("code is not null").groupBy("lemma", "code", "sequence").agg(F.count("*").alias("votes"))
    return parses.join(counts, ["lemma", "code", "sequence"], "left").withColumn("votes", F.coalesce("votes", F.lit(0)))


def marks(code: Column) -> Column:
    """The features of a code of one letter a place, each as its place and letter; hyphens are none."""
    letters = F.filter(F.transform(F.split(code, ""), lambda c, k: F.struct((k + 1).cast("string").alias("k"), c.alias("c"))), lambda x: ~x["c"].isin("", "-"))
    return F.transform(letters, lambda x: F.concat(x["k"], x["c"]))


def told_apart(parses: DataFrame) -> DataFrame:
    """parses(form, lemma, code) with k, the number of the form's parses, and special, the features by which a parse differs from another of them (all of its own, if by none)."""
    of = parses.select("form", "lemma", "code").distinct().withColumn("marks", marks(F.col("code"))).groupBy("form").agg(F.collect_list(F.struct("lemma", "code", "marks")).alias("all"))
    each = of.select("form", F.size("all").alias("k"), "all", F.explode("all").alias("p"))
    differ = F.filter("p.marks", lambda m: F.exists("all", lambda q: ~F.array_contains(q["marks"], m)))
    return each.select("form", F.col("p.lemma").alias("lemma"), F.col("p.code").alias("code"), "k", F.when(F.size(differ) > 0, differ).otherwise(F.col("p.marks")).alias("special"))


def feature_weights(parses: DataFrame, counts: DataFrame) -> DataFrame:
    """(subset, weight): how much of counts(word, n) has each set of features, a word's n shared by its parses.

    Codes are summed first, so that only as many rows as there are codes are taken apart.
    """
    known = parses.select("form", "lemma", "code").distinct()
    k = known.groupBy(F.col("form").alias("word")).agg(F.count("*").alias("k"), F.collect_list("code").alias("codes"))
    codes = counts.join(k, "word").select(F.explode("codes").alias("code"), (F.col("n") / F.col("k")).alias("w")).groupBy("code").agg(F.sum("w").alias("w"))
    parts = codes.withColumn("marks", marks(F.col("code"))).withColumn("mask", F.explode(F.expr("sequence(0, shiftleft(1, size(marks)) - 1)")))
    subset = F.array_join(F.filter("marks", lambda m, i: F.call_function("getbit", F.col("mask"), i) == 1), ";")
    return parts.groupBy(subset.alias("subset")).agg(F.sum("w").alias("weight"))


def by_form_frequency(parses: DataFrame, counts: DataFrame) -> DataFrame:
    """(form, lemma, code, weight, share): each parse of the forms in counts(word, n) by how frequent the features are that tell it apart.

    weight is looked up in feature_weights(); share is its part of the form's, equal parts if none of them has any.
    """
    rows = told_apart(parses).join(counts.select(F.col("word").alias("form")), "form", "left_semi")
    rows = rows.withColumn("subset", F.array_join("special", ";")).join(feature_weights(parses, counts), "subset", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    return _shares(rows.select("form", "lemma", "code", "weight"), ["form"], "weight")


def _shares(rows: DataFrame, unit: list[str], weight: str) -> DataFrame:
    w = Window.partitionBy(*unit)
    total = F.sum(weight).over(w)
    return rows.withColumn("share", F.when(total > 0, F.col(weight) / total).otherwise(1.0 / F.count("*").over(w)))


def word_pairs(docs: DataFrame) -> DataFrame:
    """(previous, word, n): how often each word follows each other along the texts of docs(text), lower case; pairs are made within a row, then counted."""
    ws = docs.where("text is not null").select(F.transform(words(F.col("text")), lambda w: F.lower(w)).alias("ws"))
    both = F.arrays_zip(F.slice("ws", F.lit(1), F.size("ws") - 1).alias("previous"), F.slice("ws", F.lit(2), F.size("ws")).alias("word"))
    return ws.where("size(ws) > 1").select(F.explode(both).alias("p")).groupBy("p.previous", "p.word").agg(F.count("*").alias("n"))


def by_prior_frequency(parses: DataFrame, pairs: DataFrame) -> DataFrame:
    """(previous, form, lemma, code, weight, share): each parse of a word by how often such a one follows what the word before it may be.

    pairs(previous, word, n) are counted on the lattice of parses: a pair adds n over the number of parses of both words to each pair of parses.
    A parse's weight is the sum over pairs that end in it (lemma and code) and begin with a code of the word before; if all codes of that word are
    trivial, telling only a part of speech, with a lemma of it; if it has no parse, with anything. share is its part of the word's, equal parts if none has any.
    """
    known = parses.select("form", "lemma", "code").distinct()
    k = known.groupBy("form").agg(F.count("*").alias("k"), F.collect_list(F.struct("lemma", "code")).alias("ps"))
    telling = F.exists("ps", lambda p: ~F.rlike(p["code"], F.lit("^.-*$")))
    before = k.select(F.col("form").alias("previous"), F.col("k").alias("kp"), F.col("ps").alias("before"), telling.alias("telling"))
    lattice = pairs.join(k.withColumnRenamed("form", "word"), "word").join(before, "previous", "left")
    lattice = lattice.select("previous", "word", "n", "k", "ps", "kp", "telling", "before", F.when(F.col("telling"), F.array_distinct(F.transform("before", lambda p: F.concat(F.lit("c:"), p["code"])))).when(F.col("before").isNotNull(), F.array_distinct(F.transform("before", lambda p: F.concat(F.lit("l:"), p["lemma"])))).otherwise(F.array(F.lit("*"))).alias("asked"))
    lattice = kept(lattice, "lattice")
    # every pair of parses counts under the code and the lemma of its first, and under neither
    ways = F.concat(F.array(F.lit("*")), F.coalesce(F.flatten(F.transform("before", lambda p: F.array(F.concat(F.lit("c:"), p["code"]), F.concat(F.lit("l:"), p["lemma"])))), F.array().cast("array<string>")))
    counted = lattice.where("before is not null").select(F.explode("ps").alias("p"), "n", "k", "kp", F.explode(ways).alias("way"))
    part = F.when(F.col("way") == "*", F.col("n") / F.col("k")).otherwise(F.col("n") / (F.col("k") * F.col("kp")))
    table = counted.groupBy("way", F.col("p.lemma").alias("lemma"), F.col("p.code").alias("code")).agg(F.sum(part).alias("w"))
    wanted = lattice.select("previous", "word", F.explode("ps").alias("p"), "asked").select("previous", "word", "p.lemma", "p.code", F.explode("asked").alias("way"))
    scored = wanted.join(table, ["way", "lemma", "code"], "left").groupBy("previous", F.col("word").alias("form"), "lemma", "code").agg(F.coalesce(F.sum("w"), F.lit(0.0)).alias("weight"))
    return _shares(scored, ["previous", "form"], "weight")


def chosen_in_context(docs: DataFrame, parses: DataFrame) -> DataFrame:
    """(doc_id, pos, word, lemma, code, score): the best parse of each word of docs(doc_id, text) that has one, where it stands.

    The score is the mean of both evaluators' shares, rounded to nine places; of equal ones the least lemma and code is taken. The first word of a text has no
    word before it and is judged by its features. Scores are made once for each pair of words, then joined to where it stands; pos counts
    all words from 1. Rows that repeat an id are read each by itself.
    """
    rows = docs.where("text is not null").select("doc_id", F.transform(words(F.col("text")), lambda w: F.lower(w)).alias("ws"))
    both = F.arrays_zip(F.concat(F.array(F.lit(None).cast("string")), F.slice("ws", F.lit(1), F.greatest(F.size("ws") - 1, F.lit(0)))).alias("previous"), F.col("ws").alias("word"))
    places = rows.where("size(ws) > 0").select("doc_id", F.posexplode(both).alias("k", "p")).select("doc_id", (F.col("k") + 1).alias("pos"), "p.previous", "p.word")
    pairs = kept(word_pairs(docs), "pairs")
    counts = kept(rows.select(F.explode("ws").alias("word")).groupBy("word").agg(F.count("*").alias("n")), "counts")
    by_form = by_form_frequency(parses, counts).select("form", "lemma", "code", F.col("share").alias("own"))
    by_prior = by_prior_frequency(parses, pairs).select("previous", "form", "lemma", "code", F.col("share").alias("after"))
    first = by_form.select(F.lit("").alias("previous"), "form", "lemma", "code", F.col("own").alias("score"))
    scores = by_prior.join(by_form, ["form", "lemma", "code"]).select("previous", "form", "lemma", "code", ((F.col("own") + F.col("after")) / 2).alias("score")).unionByName(first)
    top = F.min(F.struct((-F.round("score", 9)).alias("s"), "lemma", "code")).alias("top")
    best_of = scores.groupBy("previous", F.col("form").alias("word")).agg(top)
    found = places.withColumn("previous", F.coalesce("previous", F.lit(""))).join(best_of, ["previous", "word"])
    return found.select("doc_id", "pos", "word", "top.lemma", "top.code", (-F.col("top.s")).alias("score"))


def best(scores: DataFrame) -> DataFrame:
    """The best parse of each form by the mean over the evaluators that score it (x), over the sum of the form's means.

    Ties go to the least lemma and code. Means that sum to nothing stay as they are.
    """
    mean = scores.where("x is not null").groupBy("form", "lemma", "code").agg(F.avg("x").alias("mean"))
    w = Window.partitionBy("form")
    rows = mean.withColumn("_total", F.sum("mean").over(w)).withColumn("_k", F.row_number().over(w.orderBy(F.desc(F.round("mean", 9)), "lemma", "code")))
    return rows.where("_k = 1").withColumn("score", F.when(F.col("_total") > 0, F.col("mean") / F.col("_total")).otherwise(F.col("mean"))).drop("_total", "_k", "mean")
