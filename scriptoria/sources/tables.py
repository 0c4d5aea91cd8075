"""Sources and sinks: tables, line chunks, tokens, parses, markup files, posting files and exports."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptoria.functions.text import deaccent, running_starts, words

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt to all cores if their files would make fewer tasks than there are cores, else as they are.

    A few files in one piece each would keep all but a few cores idle while texts are read; larger tables have
    pieces enough and are not shuffled.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def tasks_for(rows: DataFrame, most: int) -> int:
    """As many tasks as shuffles have, or as leave each no more than most of rows on average; a count of Parquet files reads no column."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // most))


def dealt(rows: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """rows by a key in that many tasks, or as many as shuffles have.

    Texts unfold into many times their rows, so tasks must not be merged by the size of what is shuffled. What follows
    by that key, alone or with others, is not shuffled again.
    """
    return rows.repartition(tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def line_chunks(docs: DataFrame) -> DataFrame:
    """One row for each line of docs(doc_id, lang, source, text): 1-based line and its character span.

    end_offset is exclusive and leaves the line break out. Spans come from running sums over a
    document's own lines, so no shuffle is needed. Null texts have no line, an empty one has an empty line.
    """
    rows = docs.where("text is not null").select("doc_id", "lang", "source", F.split("text", "\n", -1).alias("lines"))
    rows = running_starts(rows.withColumn("sizes", F.transform("lines", lambda line: F.length(line) + 1)), "sizes", "starts")
    each = rows.select("doc_id", "lang", "source", F.posexplode(F.arrays_zip("lines", F.col("starts").alias("start"))).alias("k", "z"))
    return each.select("doc_id", "lang", "source", (F.col("k") + 1).alias("line"), F.col("z.lines").alias("line_text"), F.col("z.start").alias("start_offset"), (F.col("z.start") + F.length("z.lines")).alias("end_offset"))


def tokens(docs: DataFrame, language: str = "default") -> DataFrame:
    """(doc_id, lang, source, line, i, form, word): words of each line, i from 1 within it.

    (line, i) orders a document's tokens; word is lower case.
    """
    lines = docs.where("text is not null").select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n", -1)).alias("k", "line_text"))
    each = lines.select("doc_id", "lang", "source", (F.col("k") + 1).alias("line"), F.posexplode(words(F.col("line_text"), language)).alias("j", "form"))
    return each.select("doc_id", "lang", "source", "line", (F.col("j") + 1).alias("i"), "form", F.lower("form").alias("word"))


def numbered(rows: DataFrame) -> DataFrame:
    """tokens() with pos, the place in the whole document."""
    return rows.withColumn("pos", F.row_number().over(Window.partitionBy("doc_id").orderBy("line", "i")))


# Regular endings and the code of the forms that they make.
ENDINGS = [("", "n-s------"), ("s", "n-p------"), ("es", "n-p------"), ("s", "v3spia---"), ("ed", "v--iia---"), ("ing", "v--pp----"), ("er", "a-------c"), ("est", "a-------s"), ("ly", "d--------")]


def inflected(lemmas: DataFrame) -> DataFrame:
    """A parse table (form, lemma, code) of lemmas(lemma): every headword with each regular ending."""
    endings = F.array(*(F.struct(F.lit(e).alias("ending"), F.lit(c).alias("code")) for e, c in ENDINGS))
    return lemmas.select("lemma", F.explode(endings).alias("e")).select(F.concat("lemma", "e.ending").alias("form"), "lemma", F.col("e.code").alias("code")).distinct()


def small(rows: DataFrame, most: int = 200_000) -> DataFrame:
    """rows to be broadcast if there are no more than most, else as they are."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def parsed(rows: DataFrame, parses: DataFrame) -> DataFrame:
    """tokens() joined with the lemmas of parses(form, lemma): one row for each, and k, their number.

    A form that the table lacks is its own only lemma. Repeated parses count once.
    """
    known = parses.groupBy(F.col("form").alias("word")).agg(F.collect_set("lemma").alias("lemmas"))
    found = rows.join(small(known), "word", "left").withColumn("lemmas", F.coalesce("lemmas", F.array("word")))
    return found.withColumn("k", F.size("lemmas")).select("*", F.explode("lemmas").alias("lemma")).drop("lemmas")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; only a local master may leave it unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="scriptoria-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(rows: DataFrame, name: str) -> DataFrame:
    """Write a table that several branches read to the shared folder, and read it back."""
    path = shared_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def folded(rows: DataFrame) -> DataFrame:
    return rows.withColumn("lookup", deaccent(F.col("word")))


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Rows of markup files: one for each row_tag element, attributes as columns that begin with _."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def analyses(spark: SparkSession, path: str) -> DataFrame:
    """(form, expanded, headword, sequence, features): analysis files, forms and lemmas without # and hyphened prefixes, a lemma's number apart.

    expanded is the form with its quantities where a file has it, else the form. Repeated analyses are one.
    """
    raw = xml_rows(spark, path, "analysis", "form string, orth string, lemma string, pos string, number string, gender string, `case` string, tense string, mood string, voice string, person string")
    clean = F.regexp_replace(F.regexp_replace("lemma", "#", ""), r"^.+-(.+)$", "$1")
    names = ("pos", "number", "gender", "case", "tense", "mood", "voice", "person")
    rows = raw.select(
        F.regexp_replace("form", "#", "").alias("form"),
        F.regexp_replace(F.coalesce("orth", "form"), "#", "").alias("expanded"),
        F.regexp_replace(clean, r"^(\D+)\d+$", "$1").alias("headword"),
        F.regexp_extract(clean, r"^\D+(\d+)$", 1).try_cast("int").alias("sequence"),
        *(F.col(f"`{c}`") for c in names),
    ).distinct()
    features = F.map_filter(F.create_map(*(x for c in names for x in (F.lit(c), F.col(f"`{c}`")))), lambda _, v: v.isNotNull())
    return rows.select("form", "expanded", "headword", "sequence", features.alias("features"))


def senses(spark: SparkSession, path: str) -> DataFrame:
    """Sense rows of lexicon files: ids of the form n<entry>.<sense>, definitions cut at 100 characters."""
    from scriptoria.functions.text import short_definition

    raw = xml_rows(spark, path, "sense", "_id string, _n string, _level int, _VALUE string")
    part = lambda k: F.regexp_extract("_id", r"n(\d+)\.(\d+)", k).try_cast("int")
    return raw.select(part(1).alias("entry_id"), part(2).alias("sense_id"), F.col("_n").alias("sense"), F.col("_level").alias("level"), short_definition(F.trim("_VALUE")).alias("definition"))


def places(spark: SparkSession, path: str) -> DataFrame:
    """Gazetteer or marker rows with coordinates; rows at 0, 0 are unknown and left out."""
    raw = xml_rows(spark, path, "marker", "_lat double, _lng double, _site string")
    return raw.select(F.col("_site").alias("site"), F.col("_lat").alias("lat"), F.col("_lng").alias("lon")).where("lat != 0 and lon != 0")


def abbreviations(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated lines: tokens joined by |, display form, target."""
    raw = spark.read.schema("tokens string, display string, target string").option("sep", "\t").csv(path)
    return raw.select(F.split("tokens", r"\|").alias("tokens"), "display", "target")


def stoplist(spark: SparkSession, path: str) -> DataFrame:
    """Words of a one-word-per-line file."""
    return spark.read.text(path).select(F.trim("value").alias("word")).where("word != ''").distinct()


def separated(spark: SparkSession, path: str, schema: str, separator: str) -> DataFrame:
    return spark.read.schema(schema).option("sep", separator).csv(path)


def language_table(spark: SparkSession, path: str) -> DataFrame:
    """(code, name, abbreviations, id) of a properties file of lines prefix.code[.property]: value."""
    raw = spark.read.text(path).where(F.rlike("value", F.lit(r"^[\w.]+\.lang\.")))
    part = lambda k: F.regexp_extract("value", r"\.lang\.([^.:]+)(?:\.(\w+))?:\s*(.*)$", k)
    rows = raw.select(part(1).alias("code"), part(2).alias("property"), F.trim(part(3)).alias("v"))
    first = lambda p: F.max(F.when(F.col("property") == p, F.col("v")))
    return rows.groupBy("code").agg(first("").alias("name"), F.array_sort(F.collect_set(F.when(F.col("property") == "abbrev", F.col("v")))).alias("abbreviations"), first("id").try_cast("int").alias("id"), F.coalesce(first("morph_data") == "true", F.lit(False)).alias("morph"))


def write_postings(rows: DataFrame, path: str) -> None:
    """Inverted index (term, doc_id, line, positions) in Parquet, a folder for each language.

    Rewriting some languages leaves the others: only the partitions in rows are replaced.
    """
    index = rows.groupBy("lang", F.col("word").alias("term"), "doc_id", "line").agg(F.array_sort(F.collect_list("i")).alias("positions"))
    index.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lang").parquet(path)


def write_timeplot(counts: DataFrame, path: str) -> None:
    """year,count lines, a folder for each language and word."""
    counts.orderBy("year").select("lang", "word", F.concat_ws(",", "year", "count").alias("value")).write.mode("overwrite").partitionBy("lang", "word").text(path)


def marker_xml(rows: DataFrame) -> DataFrame:
    """One marker element a row of (site, lat, lon)."""
    from scriptoria.functions.text import xml_escaped

    return rows.select(F.format_string('<marker lat="%s" lng="%s" site="%s"/>', F.col("lat"), F.col("lon"), xml_escaped(F.col("site"))).alias("value"))


def annotation_rdf(rows: DataFrame, base: str) -> DataFrame:
    """One annotation of a place in a text a row of (n, citation, place)."""
    return rows.select(F.format_string("<%s/annotations/%s> a oac:Annotation ; oac:hasBody <%s/places/%s> ; oac:hasTarget <%s/texts/%s> .", F.lit(base), F.col("n"), F.lit(base), F.col("place"), F.lit(base), F.col("citation")).alias("value"))
