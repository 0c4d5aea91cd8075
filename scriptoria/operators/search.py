"""Boolean, phrase and expanded search over tokens, paging by document, and highlighting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.sources.tables import small


def postings(tokens: DataFrame) -> DataFrame:
    """Occurrences of each term in each line."""
    return tokens.groupBy("lang", "word", "doc_id", "line").agg(F.count("*").alias("n"))


def all_words(tokens: DataFrame, words: list[str], unit: list[str]) -> DataFrame:
    wanted = sorted(set(words))
    return tokens.where(F.col("word").isin(wanted)).groupBy(*unit).agg(F.countDistinct("word").alias("_n")).where(F.col("_n") == len(wanted)).select(*unit)


def any_words(tokens: DataFrame, words: list[str], unit: list[str]) -> DataFrame:
    return tokens.where(F.col("word").isin(words)).select(*unit).distinct()


def boolean(tokens: DataFrame, unit: list[str], required: list[str] = (), allowed: list[str] = (), excluded: list[str] = (), phrase: list[str] = ()) -> DataFrame:
    """Units that hold all required words and the phrase, one allowed word, and no excluded one.

    One pass counts all words by unit. With only a phrase, or nothing at all, no word is counted.
    """
    if not (required or allowed or excluded):
        return phrase_hits(tokens, phrase, unit).select(*unit).distinct() if phrase else tokens.select(*unit).distinct()
    used = sorted({*required, *allowed, *excluded})
    out = tokens.where(F.col("word").isin(used)) if required or allowed else tokens
    marks = out.groupBy(*unit).agg(*(F.max((F.col("word") == w).cast("int")).alias(f"_{k}") for k, w in enumerate(used)))
    has = {w: F.col(f"_{k}") == 1 for k, w in enumerate(used)}
    test = F.lit(True)
    for w in required:
        test &= has[w]
    if allowed:
        test &= F.greatest(*(has[w].cast("int") for w in allowed), F.lit(0)) == 1
    for w in excluded:
        test &= ~has[w]
    out = marks.where(test).select(*unit)
    return out.join(phrase_hits(tokens, phrase, unit).select(*unit).distinct(), unit, "left_semi") if phrase else out


def phrase_hits(tokens: DataFrame, phrase: list[str], unit: list[str]) -> DataFrame:
    """Where the words of a phrase follow each other within a unit: unit and i of the first.

    Occurrences of the phrase's own words are grouped by where the phrase would start, so rare
    words make few rows and no window over whole texts is needed. Repeated rows count once.
    """
    places = F.filter(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(w).alias("w")) for k, w in enumerate(phrase))), lambda p: p["w"] == F.col("word"))
    parts = tokens.where(F.col("word").isin(sorted(set(phrase)))).select(*unit, "i", F.explode(places).alias("p")).select(*unit, (F.col("i") - F.col("p.k")).alias("i"), "p.k")
    return parts.groupBy(*unit, "i").agg(F.size(F.collect_set("k")).alias("_n")).where(F.col("_n") == len(phrase)).select(*unit, "i")


def whole_phrases(texts: DataFrame, phrases: DataFrame, key: str, item: str, anchor: int = 3) -> DataFrame:
    """(item, key): phrases(item, phrase) that texts(key, words) hold, word for word and in order.

    Windows of a phrase's first words (anchor of them, or all of a shorter one's) are joined by hash; then the whole phrase is compared
    where a window matched. Empty phrases match nothing.
    """
    known = phrases.where(F.size("phrase") > 0).withColumn("_n", F.least(F.size("phrase"), F.lit(anchor)))
    known = known.withColumn("_window", F.xxhash64(F.slice("phrase", F.lit(1), F.col("_n"))))

    def windows_of(n: int):
        starts = F.when(F.size("words") >= n, F.sequence(F.lit(1), F.size("words") - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda k: F.struct(k.alias("at"), F.xxhash64(F.slice("words", k, F.lit(n))).alias("_window"), F.lit(n).alias("_n")))

    windows = F.flatten(F.array(*(windows_of(n) for n in range(1, anchor + 1))))
    placed = texts.where("words is not null").select(key, F.inline(windows))
    found = placed.join(small(known.select(item, "_window", "_n")), ["_window", "_n"]).select(item, key, "at")
    pairs = found.join(known.select(item, "phrase"), item).join(texts, key)
    return pairs.where(F.slice("words", F.col("at"), F.size("phrase")) == F.col("phrase")).select(item, key).distinct()


def expanded(forms: DataFrame, words: DataFrame) -> DataFrame:
    """All forms(lemma, word) that share a lemma with words(word), with the word that asked for them."""
    lemmas = forms.join(words.select("word"), "word").select("lemma", F.col("word").alias("asked")).distinct()
    return forms.join(lemmas, "lemma").select("asked", "word").distinct()


def paged_by_document(hits: DataFrame, page: int, size: int, order: list[str]) -> DataFrame:
    """All hits of the page-th size documents (from 1), with the document's rank.

    Documents are ranked on their own short list, then joined: no window over all hits.
    """
    docs = hits.select("doc_id").distinct().orderBy("doc_id").offset((page - 1) * size).limit(size)
    ranked = docs.withColumn("doc_rank", F.row_number().over(Window.orderBy("doc_id")) + (page - 1) * size)
    return hits.join(F.broadcast(ranked), "doc_id").select("doc_rank", "doc_id", *order)


def runs(hits: DataFrame, order: list[str], key: str) -> DataFrame:
    """Numbered runs of equal key in an order within each group of the first order column."""
    w = Window.partitionBy(order[0]).orderBy(*order[1:])
    change = (F.coalesce(F.lag(key).over(w) != F.col(key), F.lit(True))).cast("int")
    return hits.withColumn("_c", change).withColumn("run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_c")


def highlighted(rows: DataFrame, words: str, wanted: list[str], around: int = 20, most: int = 8) -> DataFrame:
    """rows with snippet: words from around the first match, up to most matches marked; null without one.

    The places of matches are a column of their own, so that each is computed once a row.
    """
    at = F.filter(F.transform(words, lambda w, k: F.when(F.lower(w).isin(wanted), k + 1)), lambda k: k.isNotNull())
    out = rows.withColumn("_at", at).withColumn("_first", F.try_element_at("_at", F.lit(1))).withColumn("_from", F.greatest(F.col("_first") - around, F.lit(1))).withColumn("_marks", F.slice("_at", 1, most))
    part = F.slice(words, F.col("_from"), F.lit(2 * around + 1))
    marked = F.transform(part, lambda w, k: F.when(F.array_contains(F.col("_marks"), k + F.col("_from")), F.concat(F.lit("*"), w, F.lit("*"))).otherwise(w))
    return out.withColumn("snippet", F.when(F.col("_first").isNotNull(), F.array_join(marked, " "))).drop("_at", "_first", "_from", "_marks")


def in_context(text: Column, word: str, around: int = 200) -> Column:
    """The first match of a word with around characters on either side; null without a match."""
    at = F.instr(F.lower(text), word)
    return F.when(at > 0, F.substring(text, F.greatest(at - around, F.lit(1)), F.least(at - 1, F.lit(around)) + len(word) + around))


def headword_search(lexicon: DataFrame, head: str, text: str, mode: str) -> DataFrame:
    """exact, start, end, substring (start or end) or infix matches, in the order of the heads."""
    c = F.col(head)
    test = {"exact": c == text, "start": F.startswith(c, F.lit(text)), "end": F.endswith(c, F.lit(text)), "substring": F.startswith(c, F.lit(text)) | F.endswith(c, F.lit(text)), "infix": c.contains(text)}[mode]
    return lexicon.where(test)


def contents_search(rows: DataFrame, columns: list[str], words: list[str]) -> DataFrame:
    """Rows whose columns together hold every word."""
    contents = F.lower(F.concat_ws("\n", *(F.col(c).cast("string") for c in columns)))
    out = rows.withColumn("contents", contents)
    for w in words:
        out = out.where(F.col("contents").contains(w.lower()))
    return out.drop("contents")


def abbreviated(citations: DataFrame, citation: str, abbreviations: DataFrame) -> DataFrame:
    """Each citation with the target of the longest run of its first words that abbreviates one.

    Words are lower case and end at spaces and full stops; abbreviations(tokens array<string>,
    target) are matched whole. Citations without a match stay, with a null target.
    """
    words = F.filter(F.split(F.lower(citation), "[ .]+"), lambda w: w != "")
    rows = citations.withColumn("_words", words)
    heads = rows.select("_words").distinct().select("_words", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("_words"), F.lit(1))), lambda k: F.slice("_words", F.lit(1), k))).alias("tokens"))
    found = heads.join(abbreviations.select("tokens", "target"), "tokens").groupBy("_words").agg(F.max_by("target", F.size("tokens")).alias("target"))
    return rows.join(found, "_words", "left").drop("_words")


def possible_abbreviations(citations: DataFrame, citation: str, abbreviations: DataFrame) -> DataFrame:
    """Each citation with every target it may begin to name: its words are an abbreviation's first, the last one perhaps cut short.

    A citation with more words than an abbreviation is none of it. Without a candidate the target is null. The
    abbreviations are a checked, small table, read by their first letter.
    """
    words = F.filter(F.split(F.lower(citation), "[ .]+"), lambda w: w != "")
    asked = citations.select(words.alias("_words")).distinct().where("size(_words) > 0").withColumn("_letter", F.left(F.get("_words", F.lit(0)), F.lit(1)))
    known = abbreviations.select("tokens", "target", F.left(F.get("tokens", F.lit(0)), F.lit(1)).alias("_letter"))
    n = F.size("_words")
    fits = (n <= F.size("tokens")) & (F.slice("tokens", F.lit(1), n - 1) == F.slice("_words", F.lit(1), n - 1)) & F.startswith(F.get("tokens", n - 1), F.get("_words", n - 1))
    found = asked.join(small(known), "_letter").where(fits).select("_words", "target")
    return citations.withColumn("_words", words).join(found, "_words", "left").drop("_words")


def highlighted_phrase(tokens: DataFrame, phrase: list[str], unit: list[str], form: str) -> DataFrame:
    """(*unit, words): the words of units that hold a phrase, those of the phrase in asterisks."""
    starts = phrase_hits(tokens, phrase, unit)
    marks = starts.select(*unit, F.explode(F.sequence(F.col("i"), F.col("i") + len(phrase) - 1)).alias("i")).distinct().withColumn("_hit", F.lit(True))
    rows = tokens.join(starts.select(*unit).distinct(), unit, "left_semi").join(marks, [*unit, "i"], "left")
    word = F.when(F.col("_hit"), F.concat(F.lit("*"), form, F.lit("*"))).otherwise(F.col(form))
    return rows.groupBy(*unit).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", word.alias("w")))), lambda x: x["w"]).alias("words"))
