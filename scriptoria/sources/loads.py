"""Catalogue files as tables: lexicon entries, parses with their lemmas, artifacts, keywords, images, gazetteers.

A path is a file of markup with one root, or a folder of such files. Empty elements are empty strings,
missing elements nulls. A file that does not hold the row's element gives no rows. Repeated rows stay, unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.functions.text import short_definition, xml_escaped
from scriptoria.sources.tables import xml_rows

# How many fields a finished record of each kind of artifact has.
FIELDS = {"Building": 43, "Coin": 45, "Gem": 58, "Sculpture": 59, "Site": 17, "Vase": 53}

#: Rows of a file that write_xml writes, at most.
FILE_ROWS = 10_000


def write_xml(rows: DataFrame, path: str, root: str, row: str) -> str:
    """Write files of markup of FILE_ROWS rows at most; columns whose names begin with _ are attributes, nulls are left out. The path.

    A file with a root is read by one task, so its size must not follow the table's.
    """
    rows.write.format("xml").option("rootTag", root).option("rowTag", row).option("maxRecordsPerFile", FILE_ROWS).save(path)
    return path


def lexicon_entries(spark: SparkSession, path: str) -> DataFrame:
    """(document, n, headword, sequence, definition) of entries with a key, whose ids are n<number>.

    Long marks and syllable breaks are no part of a key; a number at its end (after # or not) tells
    homographs apart, without it the entry is the first. The definition is the first translation, else the first sense.
    """
    raw = xml_rows(spark, path, "entryFree", "_document string, _id string, _key string, tr array<string>, sense array<string>").where("_key is not null")
    key = F.regexp_replace("_key", "[_^]", "")
    numbered = F.regexp_extract(key, r"^(.*?)#?(\d+)$", 2)
    told = F.coalesce(F.get("tr", F.lit(0)), F.get("sense", F.lit(0)))
    return raw.select(
        F.col("_document").alias("document"),
        F.regexp_extract("_id", r"n(\d+)", 1).try_cast("int").alias("n"),
        F.when(numbered != "", F.regexp_extract(key, r"^(.*?)#?(\d+)$", 1)).otherwise(key).alias("headword"),
        F.when(numbered != "", numbered.try_cast("int")).otherwise(1).alias("sequence"),
        short_definition(F.nullif(F.trim(told), F.lit(""))).alias("definition"),
    )


def lemmas(entries: DataFrame, better: str | None = None) -> DataFrame:
    """(headword, sequence, definition, authority_name, display_name, sort_name): one lemma of all entries of a headword and number.

    Its definition is the last of the lexicon named better, else the first that any entry has, in the order of
    document and n; of entries in one place the smaller definition counts as the earlier.
    """
    place = F.struct("document", "n", "definition")
    of = lambda told: F.when(told & F.col("definition").isNotNull(), place)
    rows = entries.groupBy("headword", "sequence").agg(F.max(of(F.col("document") == F.lit(better))).alias("_better"), F.min(of(F.lit(True))).alias("_first"))
    name = F.concat("headword", F.col("sequence").cast("string"))
    return rows.select("headword", "sequence", F.coalesce("_better.definition", "_first.definition").alias("definition"), name.alias("authority_name"), F.col("headword").alias("display_name"), name.alias("sort_name"))


def parses_of(analyses: DataFrame, known: DataFrame) -> DataFrame:
    """analyses(form, headword, sequence, ...) with the sequence of each lemma of known(headword, sequence) that they name; those of no lemma are left out.

    An analysis without a number is one of every homograph. Repeated results are one.
    """
    rows = analyses.withColumnRenamed("sequence", "_asked").join(known.select("headword", "sequence").distinct(), "headword")
    return rows.where("_asked is null or _asked = sequence").drop("_asked")


def artifacts(spark: SparkSession, path: str, fields: dict[str, int] | None = None) -> DataFrame:
    """(name, type, location, summary, version) of finished artifacts: the version is from 0 up to 5, and there are as many fields as the type has.

    Names are escaped as markup. Types that fields does not list are left out.
    """
    own = ["name", "type", "location", "summary", "perseus_version"]
    raw = xml_rows(spark, path, "artifact", ", ".join(f"{c} string" for c in own) + ", xs_any array<string>")
    size = sum((F.col(c).isNotNull().cast("int") for c in own), F.lit(0)) + F.coalesce(F.size("xs_any"), F.lit(0))
    expected = F.create_map(*(F.lit(x) for pair in (fields or FIELDS).items() for x in pair))
    version = F.col("perseus_version").try_cast("double")
    rows = raw.where((version >= 0) & (version < 5) & (size == F.try_element_at(expected, F.col("type"))))
    return rows.select(xml_escaped(F.col("name")).alias("name"), "type", "location", "summary", version.alias("version"))


def artifact_keywords(spark: SparkSession, path: str) -> DataFrame:
    """(name, type, keyclass, keyword), names escaped as those of artifacts() are."""
    raw = xml_rows(spark, path, "artifactKeyword", "artifactName string, artifactType string, keyclass string, keyword string")
    return raw.select(xml_escaped(F.col("artifactName")).alias("name"), F.col("artifactType").alias("type"), "keyclass", "keyword")


def images(spark: SparkSession, path: str) -> DataFrame:
    """(archive_number, caption, credits, status, source_id); a status that is no number is null."""
    raw = xml_rows(spark, path, "img", "archive_number string, caption string, credits string, status string, source_id string")
    return raw.withColumn("status", F.col("status").try_cast("int"))


def image_names(spark: SparkSession, path: str) -> DataFrame:
    """(archive_number, name): every name that an image goes by, once, escaped as those of artifacts() are."""
    raw = xml_rows(spark, path, "image", "archive_number string, name string, secondary_name string, tertiary_name string, image_schema string")
    rows = raw.select("archive_number", F.explode(F.array_compact(F.array("name", "secondary_name", "tertiary_name"))).alias("name")).where("name != ''")
    return rows.select("archive_number", xml_escaped(F.col("name")).alias("name")).distinct()


def occurrences(found: DataFrame, names: DataFrame, captions: DataFrame) -> DataFrame:
    """(name, archive_number, caption): the images of each artifact, which bear its name, with their captions; an image of no caption has null.

    Artifacts without a name or images have no rows; an artifact of repeated rows has each image once.
    """
    pairs = found.select("name").distinct().join(names, "name")
    first = captions.groupBy("archive_number").agg(F.min("caption").alias("caption"))
    return pairs.join(first, "archive_number", "left").select("name", "archive_number", "caption")


def _joined(*parts: Column) -> Column:
    return F.concat_ws(", ", *parts)


def gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """(authority_name, display_name, site, state, nation, lat, lon) of rows of a gazetteer; the common name comes before the name."""
    raw = xml_rows(spark, path, "row", "id string, name string, cname string, nation string, state string, lon string, lat string")
    site = F.coalesce("cname", "name")
    return raw.select(F.col("id").alias("authority_name"), _joined(site, F.col("state"), F.col("nation")).alias("display_name"), site.alias("site"), "state", "nation", F.col("lat").try_cast("double").alias("lat"), F.col("lon").try_cast("double").alias("lon"))


def write_markers(places: DataFrame, path: str, most: int = 200) -> str:
    """Write the places(site, lat, lon, n) with the largest n as markers, at most most of them; of equal n the first by site, lat and lon."""
    top = places.orderBy(F.desc("n"), "site", "lat", "lon").limit(most)
    return write_xml(top.select(F.col("lat").alias("_lat"), F.col("lon").alias("_lng"), F.col("site").alias("_site")), path, "markers", "marker")
