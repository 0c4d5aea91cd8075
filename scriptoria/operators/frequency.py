"""Term frequencies with ambiguity, idf, vocabulary lists, rates and morphological counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions.text import words
from scriptoria.sources.tables import kept, small


def ambiguity_counts(parsed: DataFrame, *by: str) -> DataFrame:
    """max (occurrences), min (those with one candidate) and weighted (1/k each) by unit and lemma."""
    return parsed.groupBy(*by, "lemma").agg(F.count("*").alias("max_freq"), F.sum((F.col("k") == 1).cast("long")).alias("min_freq"), F.sum(1.0 / F.col("k")).alias("weighted_freq"))


def term_frequency(counts: DataFrame, *unit: str) -> DataFrame:
    """tf: occurrences over the number of distinct lemmas of the unit (not over its tokens)."""
    return counts.withColumn("tf", F.col("max_freq") / F.count("*").over(Window.partitionBy(*unit)))


def combine(counts: DataFrame, *by: str) -> DataFrame:
    """Sums of partial frequencies over coarser units."""
    return counts.groupBy(*by, "lemma").agg(*(F.sum(c).alias(c) for c in ("max_freq", "min_freq", "weighted_freq")))


def inverse_document_frequency(counts: DataFrame, held: DataFrame, *within: str) -> DataFrame:
    """Documents and totals by lemma, and log2(N / df), N the documents of the same language.

    counts has one row a document and lemma, as ambiguity_counts() gives by doc_id; held(doc_id, within) has
    the documents that hold a word, so that N is counted over documents and not over their lemmas.
    """
    n = held.select("doc_id", *within).distinct().groupBy(*within).agg(F.count("*").alias("n_docs"))
    df = counts.groupBy(*within, "lemma").agg(F.count("doc_id").alias("doc_count"), F.sum("max_freq").alias("max_occ"), F.sum("min_freq").alias("min_occ"))
    return df.join(F.broadcast(n) if within == ("lang",) else n, list(within)).withColumn("idf", F.log2(F.col("n_docs") / F.col("doc_count"))).drop("n_docs")


def tf_idf(frequencies: DataFrame, idf: DataFrame, *on: str) -> DataFrame:
    return frequencies.join(idf.select(*on, "lemma", "idf"), [*on, "lemma"]).withColumn("tf_idf", F.col("tf") * F.col("idf"))


def vocabulary(counts: DataFrame, *by: str) -> DataFrame:
    """Tokens, distinct words, words that occur once, and density (tokens over words)."""
    words = counts.groupBy(*by, "word").agg(F.sum("n").alias("n"))
    return words.groupBy(*by).agg(F.sum("n").alias("total"), F.count("*").alias("unique_words"), F.sum((F.col("n") == 1).cast("long")).alias("once")).withColumn("density", F.col("total") / F.col("unique_words"))


def per_ten_thousand(frequency: Column, total: Column) -> Column:
    return frequency / total * 10000


def rates(counts: DataFrame, by: str) -> DataFrame:
    """counts(by, ..., n) with per_10k, of the total of each by; the totals are a small table of their own."""
    total = counts.groupBy(by).agg(F.sum("n").alias("_total"))
    return counts.join(total, by).withColumn("per_10k", per_ten_thousand(F.col("n"), F.col("_total"))).drop("_total")


def coverage(weights: DataFrame, share: float, by: list[str], weight: str, key: str) -> DataFrame:
    """Rows in descending weight until share of the total is covered, the crossing row included, with their place.

    Rows of equal weight are in the order of key. Sums run over the distinct weights of a selection, few
    beside its rows; only rows of one weight are put in order. Rows of null weight are left out.
    """
    rows = weights.where(F.col(weight).isNotNull())
    steps = rows.groupBy(*by, weight).agg(F.count("*").alias("_rows"))
    w = Window.partitionBy(*by)
    above = w.orderBy(F.desc(weight)).rowsBetween(Window.unboundedPreceding, -1)
    mass = F.col("_rows") * F.col(weight)
    steps = steps.withColumn("_before", F.coalesce(F.sum(mass).over(above), F.lit(0))).withColumn("_place", F.coalesce(F.sum("_rows").over(above), F.lit(0))).withColumn("_limit", F.sum(mass).over(w) * share)
    steps = steps.where(F.col("_before") < F.col("_limit")).drop("_rows")
    place = F.row_number().over(Window.partitionBy(*by, weight).orderBy(key))
    out = rows.join(steps, [*by, weight]).withColumn("_k", place).where(F.col("_before") + (F.col("_k") - 1) * F.col(weight) < F.col("_limit"))
    return out.withColumn("place", F.col("_place") + F.col("_k")).drop("_before", "_place", "_limit", "_k")


def nth_occurrence(rows: DataFrame) -> DataFrame:
    """Which occurrence of its form in the document each token is."""
    return rows.withColumn("occurrence", F.row_number().over(Window.partitionBy("doc_id", "form").orderBy("line", "i")))


def content_pairs(docs: DataFrame, stop: list[str], language: str = "default") -> DataFrame:
    """(previous, word, n): how often each word of docs(text) has previous as the last word before it that is no stop word.

    A text is cut where its content words begin: each cut is a content word and the stop words after it, to
    which the next cut's head belongs. All of that happens within the row, so that only counts are shuffled.
    Null texts and words before the first content word give nothing; each row is a text of its own.
    """
    mark = "\u0001"  # no word holds it
    rows = docs.where("text is not null").select(F.transform(words(F.col("text"), language), F.lower).alias("_words"))
    joined = F.array_join(F.transform("_words", lambda w: F.when(w.isin(stop), w).otherwise(F.concat(F.lit(mark), w))), " ")
    rows = rows.select(F.split(joined, mark).alias("_all")).select(F.slice("_all", F.lit(2), F.size("_all") - 1).alias("_cuts"))
    heads = F.transform(F.slice("_cuts", F.lit(2), F.size("_cuts")), lambda c: F.substring_index(c, " ", 1))
    cuts = rows.select(F.inline(F.arrays_zip("_cuts", heads.alias("_next"))))
    cuts = cuts.select(F.filter(F.split("_cuts", " "), lambda w: w != "").alias("_held"), "_next")
    after = F.array_compact(F.concat(F.slice("_held", F.lit(2), F.size("_held")), F.array("_next")))
    return cuts.select(F.get("_held", F.lit(0)).alias("previous"), F.explode(after).alias("word")).groupBy("previous", "word").agg(F.count("*").alias("n"))


def feature_subsets(parses: DataFrame, features: list[str], weight: str) -> DataFrame:
    """Summed weight of every subset of the features that a row has; nulls are features it lacks.

    The empty subset is the total. A row adds once to each of its own subsets.
    """
    pairs = F.array_compact(F.array(*(F.when(F.col(f).isNotNull(), F.concat(F.lit(f + "="), F.col(f).cast("string"))) for f in features)))
    masks = F.expr("sequence(0, shiftleft(1, size(_p)) - 1)")
    subset = F.array_join(F.filter("_p", lambda p, k: F.call_function("getbit", F.col("_m"), k) == 1), ";")
    each = parses.select(weight, pairs.alias("_p")).select(weight, "_p", F.explode(masks).alias("_m"))
    return each.groupBy(subset.alias("subset")).agg(F.sum(weight).alias("weight"))


def words_by_year(rows: DataFrame) -> DataFrame:
    """Documents that hold each word, by year and language."""
    return rows.select("year", "lang", "word", "doc_id").distinct().groupBy("year", "lang", "word").agg(F.count("*").alias("n_docs"))


def bigram_weights(rows: DataFrame, previous: str, lemma: str, k: str, n: str | None = None) -> DataFrame:
    """Weight of each lemma after each previous word: 1/k for every candidate of a token; a row stands for n tokens, or one."""
    tokens = F.col(n) if n else F.lit(1.0)
    return rows.where(F.col(previous).isNotNull()).groupBy(previous, lemma).agg(F.sum(tokens / F.col(k)).alias("weight"))


def lemma_shares_in_document(parsed: DataFrame) -> DataFrame:
    """(doc_id, word, lemma, share): weight of each candidate of an ambiguous word within its document."""
    weight = parsed.groupBy("doc_id", "lemma").agg(F.sum(1.0 / F.col("k")).alias("weight"))
    words = parsed.where("k > 1").select("doc_id", "word", "lemma").distinct()
    total = F.sum("weight").over(Window.partitionBy("doc_id", "word"))
    return words.join(weight, ["doc_id", "lemma"]).withColumn("share", F.col("weight") / total).drop("weight")


def first_pages(rows: DataFrame, orders: dict[str, list], size: int) -> DataFrame:
    """rows with sorted_by and place, the first size of each of several orders, which must tell rows apart; each is a limited sort, so no task holds all rows."""
    pages = [rows.orderBy(*order).limit(size).withColumn("sorted_by", F.lit(name)).withColumn("place", F.row_number().over(Window.partitionBy("sorted_by").orderBy(*order))) for name, order in orders.items()]
    return reduce(DataFrame.unionByName, pages)


def corpus_lemmas(docs: DataFrame, parses: DataFrame, language: str = "default") -> DataFrame:
    """(lemma, max_freq, min_freq, weighted_freq, n_docs) over all of docs(doc_id, text), each row one document, by parses(form, lemma).

    A form that parses lack is its own lemma; repeated parses count once; null texts hold nothing. Words are counted before they meet their
    lemmas, so the sums shuffle vocabularies only. A lemma of one attested form is in the documents of that form; only
    words of lemmas with several are followed into their documents.
    """
    held = docs.where("text is not null").select("doc_id", F.transform(words(F.col("text"), language), F.lower).alias("_words"))
    counts = held.select(F.explode("_words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    distinct = held.select("doc_id", F.explode(F.array_distinct("_words")).alias("word"))
    in_docs = distinct.groupBy("word").agg(F.count("*").alias("n_docs"))
    forms = parses.groupBy(F.col("form").alias("word")).agg(F.collect_set("lemma").alias("lemmas"))
    known = counts.join(in_docs, "word").join(forms, "word", "left").withColumn("lemmas", F.coalesce("lemmas", F.array("word")))
    pairs = kept(known.select("word", "n", "n_docs", F.size("lemmas").alias("k"), F.explode("lemmas").alias("lemma")), "lemmas")
    sums = pairs.groupBy("lemma").agg(F.sum("n").alias("max_freq"), F.sum(F.when(F.col("k") == 1, F.col("n")).otherwise(0)).alias("min_freq"), F.sum(F.col("n") / F.col("k")).alias("weighted_freq"), F.count("*").alias("_forms"), F.max("n_docs").alias("_docs"))
    shared = kept(pairs.select("word", "lemma").join(sums.where("_forms > 1").select("lemma"), "lemma"), "shared")
    several = distinct.join(small(shared), "word").select("doc_id", "lemma").distinct().groupBy("lemma").agg(F.count("*").alias("_several"))
    return sums.join(several, "lemma", "left").select("lemma", "max_freq", "min_freq", "weighted_freq", F.coalesce("_several", "_docs").alias("n_docs"))
