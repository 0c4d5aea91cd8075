"""Named queries over artifacts and images: parts stand for artifacts, their suppliers for images."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptoria.operators import artifacts as A
from scriptoria.registry import query
from scriptoria.sources import tables as S

_KINDS = "['Building', 'Coin', 'Gem', 'Sculpture', 'Site', 'Vase', 'Other'][p_partkey % 7 + 1]"


def _artifacts(spark, d):
    kind = F.get(F.array(*(F.lit(k) for k in [*A.FACETS, "Other"])), (F.col("p_partkey") % 7).cast("int"))
    return S.table(spark, d, "part").withColumn("kind", kind)


@query("SELECT l_partkey, l_suppkey, nth FROM (SELECT l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS nth FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)) WHERE nth <= 3")
def artifact_images(spark, d):
    """The first three images of each artifact."""
    return A.first_images(S.table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct(), "l_partkey", ["l_suppkey"], 3)


@query("WITH n AS (SELECT DISTINCT p_type AS name FROM part), i AS (SELECT l_orderkey, l_linenumber, l_suppkey, any_value(p_type) AS a, any_value(p_brand) AS b FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL) SELECT n.name, count(DISTINCT l_suppkey) AS n_images FROM n JOIN i ON n.name IN (i.a, i.b) GROUP BY n.name")
def images_by_any_name(spark, d):
    part = S.table(spark, d, "part")
    images = S.table(spark, d, "lineitem").join(S.small(part.select("p_partkey", "p_type", "p_brand")), F.col("l_partkey") == F.col("p_partkey")).select("l_suppkey", F.col("p_type").alias("first"), F.col("p_brand").alias("second"))
    pairs = A.named_images(part.select(F.col("p_type").alias("name")), images, "name", ["first", "second"], "l_suppkey")
    return pairs.groupBy("name").agg(F.count("*").alias("n_images"))


@query(f"SELECT {_KINDS} AS kind, p_type AS keyword, count(*) AS n FROM part WHERE p_size > 25 GROUP BY ALL")
def artifacts_by_keyword(spark, d):
    rows = _artifacts(spark, d)
    keywords = S.table(spark, d, "part").where("p_size > 25").select("p_name", "p_partkey", F.col("p_type").alias("keyword"))
    return A.keyworded(rows.select("p_name", "p_partkey", "kind"), keywords, ["p_name", "p_partkey"]).groupBy("kind", "keyword").agg(F.count("*").alias("n"))


@query(f"SELECT {_KINDS} AS kind, count(*) FILTER (p_partkey % 3 <> 0) AS n_brand, count(*) FILTER (p_partkey % 5 <> 0) AS n_type FROM part GROUP BY ALL")
def filled_fields(spark, d):
    rows = _artifacts(spark, d).select("kind", F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).otherwise("").alias("brand"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")).alias("type"))
    return A.filled(rows, ["brand", "type"], "kind")


_FIELDS = "['Function', 'Gem_Type', 'mint', 'Type', 'Period', 'Issuing_Authority'][p_size % 6 + 1]"


@query(f"WITH f AS (SELECT p_partkey, {_KINDS} AS kind, {_FIELDS} AS field FROM part), n AS (SELECT *, CASE field WHEN 'Function' THEN 'Object Function' WHEN 'Gem_Type' THEN 'Sculpture Type' WHEN 'mint' THEN 'Context' WHEN 'Type' THEN kind || ' Type' WHEN 'Period' THEN CASE WHEN kind <> 'Site' THEN 'Period' END ELSE 'Issuing Authority' END AS facet FROM f) SELECT p_partkey, facet, coalesce((kind, facet) IN (('Building', 'Building Type'), ('Building', 'Context'), ('Building', 'Period'), ('Coin', 'Context'), ('Coin', 'Issuing Authority'), ('Coin', 'Period'), ('Gem', 'Sculpture Type'), ('Sculpture', 'Context'), ('Sculpture', 'Object Function'), ('Sculpture', 'Period'), ('Sculpture', 'Sculpture Type'), ('Site', 'Site Type'), ('Vase', 'Context'), ('Vase', 'Period')), false) AS allowed FROM n")
def browsed_facets(spark, d):
    field = F.get(F.array(*map(F.lit, ["Function", "Gem_Type", "mint", "Type", "Period", "Issuing_Authority"])), (F.col("p_size") % 6).cast("int"))
    rows = _artifacts(spark, d).select("p_partkey", "kind", A.facet_name(field, F.col("kind")).alias("facet"))
    return rows.select("p_partkey", "facet", A.is_facet(F.col("facet"), F.col("kind")).alias("allowed"))


_CONTENTS = f"contents AS (SELECT p_partkey, kind, lower(CASE kind WHEN 'Coin' THEN concat_ws(chr(10), p_brand, p_type) WHEN 'Vase' THEN concat_ws(chr(10), p_name, p_brand) ELSE concat_ws(chr(10), p_brand, p_name, p_type) END) AS contents FROM (SELECT *, {_KINDS} AS kind FROM part))"


def _contents(spark, d):
    return A.index(_artifacts(spark, d), "p_partkey", {"Coin": ["p_brand", "p_type"], "Vase": ["p_name", "p_brand"], "Other": ["p_brand", "p_name", "p_type"]}, "kind")


@query(f"WITH {_CONTENTS} SELECT p_partkey, kind, md5(contents) AS contents FROM contents")
def artifact_index(spark, d):
    return _contents(spark, d).withColumn("contents", F.md5("contents"))


@query(f"WITH {_CONTENTS} SELECT kind, count(*) AS n, min(p_partkey) AS first FROM contents WHERE contains(contents, 'brand#1') AND contains(contents, 'e') GROUP BY kind")
def artifact_search(spark, d):
    return A.found(_contents(spark, d), ["Brand#1", "e"]).groupBy("kind").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first"))


@query("SELECT s_suppkey, CAST(ceil((SELECT count(*) FROM supplier WHERE contains(lower(s_name), '1')) / 5.0) AS BIGINT) AS pages FROM supplier WHERE contains(lower(s_name), '1') ORDER BY s_suppkey LIMIT 5 OFFSET 0")
def image_search_page(spark, d):
    captions = A.index(S.table(spark, d, "supplier").withColumn("kind", F.lit("image")), "s_suppkey", {"image": ["s_name"]}, "kind")
    return A.image_page(A.found(captions, ["1"]), "s_suppkey", 1, 5)


# Citations between pages


@query(r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS target FROM pages), e AS (SELECT DISTINCT page_id AS source, target, CASE WHEN page_id % 3 = 0 THEN 'index' ELSE 'text' END AS kind FROM l) SELECT source, target, kind, row_number() OVER (PARTITION BY source ORDER BY target, kind) AS place FROM e WHERE kind = 'text' AND target IN ('/The', '/and', '/to')""")
def citations_asked_for(spark, d):
    """Distinct citations of one type to some destinations, in the order of source and destination."""
    from scriptoria.operators import extract as E

    edges = E.links(S.table(spark, d, "pages")).select(F.col("page_id").alias("source"), "target", F.when(F.col("page_id") % 3 == 0, "index").otherwise("text").alias("kind"))
    return E.ordered_citations(E.citations(edges, kind="text", target=["/The", "/and", "/to"]))


# The index of documents, written twice


@query("SELECT count(*) AS n_postings, count(DISTINCT doc_id) AS n_docs FROM (SELECT DISTINCT doc_id, line, word FROM (SELECT doc_id, line, lower(unnest(regexp_extract_all(regexp_replace(line_text, '[&_][A-Za-z]+;', ' ', 'g'), '[A-Za-z][A-Za-z\\[\\]]*'))) AS word FROM (SELECT doc_id, generate_subscripts(ls, 1) AS line, unnest(ls) AS line_text FROM (SELECT doc_id, string_split(CASE WHEN doc_id % 2 = 0 THEN text ELSE 'two words' END, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))))")
def replaced_postings(spark, d):
    """An index of all documents of which the odd ones are indexed again with another text, the second batch twice."""
    from scriptoria.streaming.incremental import current_postings, replace_documents

    docs = S.table(spark, d, "documents").where("text is not null").select("doc_id", "text", "lang", "source")
    path = S.shared_folder(spark, "index")
    write = replace_documents(path)
    write(docs, 0)
    changed = docs.where("doc_id % 2 = 1").withColumn("text", F.lit("two words"))
    write(changed, 1)
    write(changed, 1)
    return current_postings(spark, path).agg(F.count("*").alias("n_postings"), F.countDistinct("doc_id").alias("n_docs"))
