"""The incremental index: re-indexing, failed and repeated batches, compaction and the ledger."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scriptoria.streaming import incremental as I

SCHEMA = "doc_id long, lang string, source string, text string"


def docs(spark, *rows):
    return spark.createDataFrame([(i, "en", "s", t) for i, t in rows], SCHEMA)


def terms(spark, path):
    out = {}
    for r in I.current_postings(spark, path).collect():
        for p in r.positions:
            out.setdefault(r.doc_id, {})[r.line, p] = r.term
    return {i: " ".join(w for _, w in sorted(ws.items())) for i, ws in out.items()}


def size(folder):
    return len([f for f in Path(folder).rglob("*.parquet")])


def test_reindexing_and_compaction(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    write = I.replace_documents(path)
    assert terms(spark, path) == {} and I.compacted(spark, path) == -1
    write(docs(spark, (1, "one two\nthree"), (2, "two"), (3, None)), 0)
    assert I.compacted(spark, path) == 0
    once = size(tmp_path)
    for k in range(1, 4):
        write(docs(spark, (1, "one two\nthree"), (2, "two"), (3, None)), k)
    assert size(tmp_path) > 2 * once and terms(spark, path) == {1: "one two three", 2: "two"}
    assert I.compacted(spark, path) == 3 and size(tmp_path) == once and terms(spark, path) == {1: "one two three", 2: "two"}
    write(docs(spark, (1, ""), (4, "new")), 4)
    assert terms(spark, path) == {2: "two", 4: "new"}
    write(docs(spark, (1, "old words")), 2)  # a batch that the base holds already
    assert terms(spark, path) == {2: "two", 4: "new"}
    assert I.compacted(spark, path) == 4 and I.compacted(spark, path) == 4 and terms(spark, path) == {2: "two", 4: "new"}
    assert {p.name for p in (tmp_path / "index" / "bases").iterdir() if not p.name.startswith(".")} == {"documents=4", "postings=4"}


def test_a_batch_that_fails_half_way_changes_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    write = I.replace_documents(path)
    write(docs(spark, (1, "before"), (2, "kept")), 0)
    write(docs(spark, (1, "after")), 1)
    shutil.rmtree(tmp_path / "index" / "documents" / "batch=1")  # the postings are there, the table of documents is not
    assert terms(spark, path) == {1: "before", 2: "kept"}
    assert I.compacted(spark, path) == 0 and terms(spark, path) == {1: "before", 2: "kept"}
    write(docs(spark, (1, "after")), 1)
    write(docs(spark, (1, "after")), 1)
    assert terms(spark, path) == {1: "after", 2: "kept"}


def test_the_ledger_tells_what_is_due(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    given = docs(spark, (1, "one"), (2, "two")).withColumn("modified", F.lit(10))
    ledger = I.reindexed(given, spark.createDataFrame([], "doc_id long, task string, last_run int"), path, 0, F.lit(20))
    assert sorted((r.doc_id, r.last_run) for r in ledger.collect()) == [(1, 20), (2, 20)]
    changed = docs(spark, (1, "uno"), (2, "due")).withColumn("modified", F.when(F.col("doc_id") == 1, 30).otherwise(10))
    ledger = I.reindexed(changed, spark.createDataFrame(ledger.collect(), ledger.schema), path, 1, F.lit(40))
    assert sorted((r.doc_id, r.last_run) for r in ledger.collect()) == [(1, 40), (2, 20)] and terms(spark, path) == {1: "uno", 2: "two"}


@pytest.mark.parametrize("times", [1, 3])
def test_streamed_batches(spark, tmp_path, times):
    for k in range(times):
        docs(spark, (1, f"text {'x' * (k + 1)}"), (k + 2, "more")).write.mode("append").parquet(f"file://{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"file://{tmp_path}/in")
        stream.writeStream.foreachBatch(I.replace_documents(f"file://{tmp_path}/index")).option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
        I.compacted(spark, f"file://{tmp_path}/index")
    assert terms(spark, f"file://{tmp_path}/index") == {1: "text " + "x" * times} | {k + 2: "more" for k in range(times)}
