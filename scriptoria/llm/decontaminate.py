"""Benchmark decontamination by template windows.

Numbers, names and units become typed placeholders; windows of such words are hashed and joined to
those of the benchmark. A window counts only if its slots are consistent: what the benchmark
repeats in several slots must be the same in all of them in this occurrence of the item. So questions
asked again with other numbers, names or units are found too. Windows of too few plain words for that
are joined as they stand, values included. Column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import saved

#: Words of a window, literal words that one must have (of an item shorter than a window, SHORT and half its words), and distinct windows that make a finding.
WINDOW, LITERAL, SHORT, FOUND = 8, 4, 3, 3
#: Pairs of words that begin a window, tested before windows are made, at most; with more of them all windows are made.
PAIRS = 20_000
#: Benchmark windows (some 40 bytes each), and ids of texts to be read again, that are broadcast at most; more are joined by shuffle.
BROADCAST = 400_000
#: Marks a placeholder (the letter after it is its type); the end of a name while a text is read; what joins a name's words.
MARK, END, JOIN = "\x02", "\x03", "\x04"
# Units of measure that follow a number.
UNITS = ["km", "m", "cm", "mm", "mi", "ft", "in", "kg", "g", "mg", "lb", "oz", "l", "ml", "h", "hours", "hour", "min", "minutes", "s", "seconds", "ms", "days", "day", "years", "year", "meters", "metres", "miles", "feet", "inches", "dollars", "euros", "pounds", "usd", "eur", "percent", "degrees", "kb", "mb", "gb", "tb", "hz", "khz", "mhz", "ghz", "w", "kw", "v", "a", "n", "j", "pa"]

# Words that begin questions and sentences in four languages and are no names when capitalised.
NO_NAMES = ["A", "An", "And", "Are", "At", "But", "By", "Can", "Compute", "Could", "Did", "Do", "Does", "Find", "For", "From", "Given", "How", "If", "In", "Is", "It", "Let", "Of", "On", "Or", "Should", "Solve", "Suppose", "That", "The", "Then", "There", "This", "To", "Was", "Were", "What", "When", "Where", "Which", "Who", "Whom", "Whose", "Why", "Will", "With", "Would"]
NO_NAMES += ["Das", "Der", "Die", "Ein", "Eine", "Ist", "Sind", "Und", "Wann", "Warum", "Welche", "Welcher", "Welches", "Wer", "Wie", "Wo"]
NO_NAMES += ["Combien", "Comment", "Des", "Est", "Et", "Le", "Les", "La", "Où", "Pourquoi", "Quand", "Que", "Quel", "Quelle", "Quelles", "Quels", "Qui", "Un", "Une"]
NO_NAMES += ["Cuál", "Cuándo", "Cuánto", "Cuántos", "Cómo", "Dónde", "El", "Es", "Los", "Las", "Por", "Qué", "Quién", "Una", "Y"]


def slotted(text: Column) -> Column:
    """Words of a text, lower-cased; those in slots begin with MARK and n(ame), d(igits) or u(nit).

    A name is a run of capitalised words, wherever it stands: one slot, its words joined. NO_NAMES are none.
    """
    text = F.coalesce(text, F.lit(""))
    out = F.when(F.rlike(text, F.lit(f"[{MARK}{END}{JOIN}]")), F.translate(text, MARK + END + JOIN, "   ")).otherwise(text)
    out = F.regexp_replace(out, r"(^|[^\p{L}\p{N}])(\p{Lu}[\p{L}\p{M}]*)", f"$1{MARK}n$2{END}")
    out = F.regexp_replace(out, f"{MARK}n({'|'.join(NO_NAMES)}){END}", "$1")
    out = F.replace(F.replace(out, F.lit(f"{END} {MARK}n"), F.lit(JOIN)), F.lit(END), F.lit(""))
    out = F.lower(out)
    out = F.regexp_replace(out, r"(^|[^\p{L}\p{N}])(\p{Nd}+(?:[.,]\p{Nd}+)*)", f"$1{MARK}d$2")
    out = F.regexp_replace(out, rf"({MARK}d[\p{{Nd}}.,]*\p{{Nd}}) ?({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f"$1 {MARK}u$2")
    return F.regexp_extract_all(out, F.lit(rf"{MARK}n[\p{{L}}\p{{M}}{JOIN}]+|{MARK}d\p{{Nd}}+(?:[.,]\p{{Nd}}+)*|{MARK}?[\p{{L}}\p{{N}}]+"), F.lit(0))


def _kind(word: Column) -> Column:
    return F.when(F.startswith(word, F.lit(MARK)), F.left(word, F.lit(2))).otherwise(word)


def _windows(hashes: str, size: int, exact: bool, begin: list[int] | None = None) -> Column:
    """(at, window) of each run of size words in a column of word hashes; none if the list is shorter.

    begin: xxhash64 of the first two words' hashes of those that are wanted; others are not made.
    """
    wanted = f"filter(sequence(0, size({hashes}) - {size}), k -> xxhash64({hashes}[k], {hashes}[k + 1]) IN ({', '.join(map(str, begin))}))" if begin else f"sequence(0, size({hashes}) - {size})"
    made = F.expr(f"transform({wanted}, k -> struct(k AS at, xxhash64({2 * size + exact}, slice({hashes}, k + 1, {size})) AS window))")
    return F.when(F.size(hashes) >= size, made).otherwise(F.expr("array()").cast("array<struct<at:int,window:bigint>>"))


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(_kind(w)))


def _plain(words: Column) -> Column:
    """Hashes of the words themselves, whether in slots or not."""
    return F.transform(words, lambda w: F.xxhash64(F.when(F.startswith(w, F.lit(MARK)), F.substring(w, 3, 1 << 30)).otherwise(w)))


def _is_slot(word: Column) -> Column:
    return F.startswith(word, F.lit(MARK))


def _benchmark_windows(items: DataFrame, words: int, literal: int, sizes: list[int]) -> DataFrame:
    """(item_id, item_key, item_at, window, size, slots, exact, pair): each item's windows, those of few plain words as they stand; pair is their beginning."""
    size = F.least(F.size("words"), F.lit(words))
    made = None
    for n in sizes:
        least = literal if n == words else max(SHORT, -(-n // 2))
        some = items.where(size == n).withColumn("kinds", _hashed(F.col("words"))).withColumn("plain", _plain(F.col("words")))
        some = some.select("item_id", "item_key", "words", "kinds", "plain", F.posexplode(_windows("kinds", n, False)).alias("k", "w"), _windows("plain", n, True).alias("as_is"))
        slots = F.size(F.filter(F.slice("words", F.col("k") + 1, F.lit(n)), _is_slot))
        some = some.withColumn("slots", slots).withColumn("exact", (F.col("slots") > 0) & (F.lit(n) - F.col("slots") < least))
        window = F.when(F.col("exact"), F.element_at("as_is", F.col("k") + 1)["window"]).otherwise(F.col("w.window"))
        pair = F.when(F.col("exact"), F.expr("xxhash64(plain[k], plain[k + 1])")).otherwise(F.expr("xxhash64(kinds[k], kinds[k + 1])"))
        some = some.select("item_id", "item_key", F.col("k").alias("item_at"), window.alias("window"), F.lit(n).alias("size"), "slots", "exact", pair.alias("pair"))
        made = some if made is None else made.union(some)
    return made


def contaminated(docs: DataFrame, benchmark: DataFrame, words: int = WINDOW, literal: int = LITERAL, found: int = FOUND) -> DataFrame:
    """(doc_id, item_id, windows, item_windows, slots) for each benchmark item found in a document.

    An item is found in a document if at least found of its distinct windows (all, if it has
    fewer) are there with consistent slots. If one value of the item stands for two values in an occurrence,
    the windows that hold it do not count there; others do, so that a verbatim copy with one changed word
    is found. Windows with fewer than literal plain words count only where the document has the same words
    and values, and only for items not found without them. slots is how many of the windows counted
    hold placeholders. An item shorter than a window is one window of its own length, with other values
    too if SHORT of its words and half of them are plain. Null and empty texts hold nothing; rows with a
    null id are left out; rows that repeat an id are one set of texts, each read by itself, and so
    are items. Documents where nothing is found give no row. Other columns are ignored.
    """
    key = F.xxhash64(F.col("text").cast("string"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), key.alias("item_key"), slotted(F.col("text").cast("string")).alias("words")).where("item_id is not null and size(words) > 0")
    items = saved(items.distinct(), "items")
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("doc_key"), F.col("text").cast("string").alias("text"))
    sizes = sorted({words, *(r[0] for r in items.select(F.least(F.size("words"), F.lit(words))).distinct().collect())})
    known = saved(_benchmark_windows(items, words, literal, sizes), "windows")
    # one scan: the words' hashes once, then the windows of all sizes that begin as a wanted one does
    begins = {(r["size"], r["exact"]): sorted(r["pairs"]) for r in known.groupBy("size", "exact").agg(F.slice(F.collect_set("pair"), 1, PAIRS + 1).alias("pairs")).collect()}
    begins = {(n, e): None if n < 2 or len(p) > PAIRS else p for (n, e), p in begins.items()}
    right = F.broadcast(known.drop("pair")) if known.count() <= BROADCAST else known.drop("pair")
    hashes = rows.select("doc_id", "doc_key", slotted(F.col("text")).alias("words")).select("doc_id", "doc_key", _hashed(F.col("words")).alias("kinds"), (_plain(F.col("words")) if any(e for _, e in begins) else F.lit(None)).alias("plain"))
    none = F.expr("array()").cast("array<struct<at:int,window:bigint>>")
    windows = F.concat(none, *(_windows("plain" if e else "kinds", n, e, p) for (n, e), p in sorted(begins.items())))
    placed = hashes.select("doc_id", "doc_key", F.inline(windows))
    hits = placed.join(right, "window")
    hits = saved(hits.withColumn("shift", F.col("at") - F.col("item_at")), "hits")
    wrong = _inconsistent(hits.where("slots > 0 and not exact"), rows, items)
    good = hits if wrong is None else hits.join(wrong, ["doc_id", "doc_key", "item_id", "item_key", "at", "item_at", "size", "exact"], "left_anti")

    def distinct(condition: Column) -> Column:
        return F.size(F.collect_set(F.when(condition, F.col("window")))).cast("long")

    seen = good.groupBy("doc_id", "item_id").agg(distinct(~F.col("exact")).alias("free"), distinct(~F.col("exact") & (F.col("slots") > 0)).alias("filled"), distinct(F.col("exact")).alias("fixed"))
    of = known.groupBy("item_id").agg(distinct(~F.col("exact")).alias("n_free"), distinct(F.col("exact")).alias("n_fixed"))
    first = (F.col("n_free") > 0) & (F.col("free") >= F.least(F.lit(found), F.col("n_free")))
    second = (F.col("fixed") > 0) & (F.col("free") + F.col("fixed") >= F.least(F.lit(found), F.col("n_free") + F.col("n_fixed")))
    more = F.when(~first, F.col("fixed")).otherwise(0)
    out = seen.join(of, "item_id").where(first | second)
    return out.select("doc_id", "item_id", (F.col("free") + more).alias("windows"), (F.col("n_free") + F.when(~first, F.col("n_fixed")).otherwise(0)).alias("item_windows"), (F.col("filled") + more).alias("slots"))


def _inconsistent(hits: DataFrame, rows: DataFrame, items: DataFrame) -> DataFrame | None:
    """The keys of hits that hold a benchmark value which stands for two values in their occurrence; names are compared by their last words. None if no hit has slots."""
    if hits.limit(1).count() == 0:
        return None
    where = ["doc_id", "doc_key", "item_id", "item_key", "shift"]
    ids = saved(hits.select("doc_id", "doc_key").distinct(), "ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST else ids
    texts = rows.join(ids, ["doc_id", "doc_key"], "left_semi").dropDuplicates(["doc_id", "doc_key"]).select("doc_id", "doc_key", slotted(F.col("text")).alias("here"))
    pairs = hits.join(texts, ["doc_id", "doc_key"]).join(items, ["item_id", "item_key"])
    pairs = pairs.select(*where, "at", "item_at", "size", "exact", F.explode(F.arrays_zip(F.slice("words", F.col("item_at") + 1, F.col("size")).alias("asked"), F.slice("here", F.col("at") + 1, F.col("size")).alias("given"))).alias("p"))
    last = lambda w: F.regexp_replace(w, f"^{MARK}n.*{JOIN}", f"{MARK}n")  # noqa: E731  a name is known by its last word
    pairs = saved(pairs.where(_is_slot(F.col("p.asked"))).select(*where, "at", "item_at", "size", "exact", last(F.col("p.asked")).alias("asked"), last(F.col("p.given")).alias("given")), "slots")
    two = pairs.groupBy(*where, "asked").agg(F.min("given").alias("low"), F.max("given").alias("high")).where("low != high").select(*where, "asked")
    return saved(pairs.join(two, [*where, "asked"], "left_semi").select("doc_id", "doc_key", "item_id", "item_key", "at", "item_at", "size", "exact").distinct(), "wrong")
