"""The pipeline's stages, each against a plain version on its own input, and edge cases."""

from __future__ import annotations

import shutil

import corpus_pipeline as P
from scriptoria.llm.common import saved
from tests.llm.test_operators import EDGE, plain_components

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    for name, stage in P.STAGES:
        before = docs
        docs = saved(stage(spark, before, FOLDER), "stage")
        if name != P.STAGES[-1][0]:
            assert docs.columns == P.COLUMNS
        gone = ids(before) - ids(docs)
        assert ids(docs) <= ids(before)
        if name == "toxicity":
            judged = [d for d in gone if d in labels]
            assert sum(labels[d].toxic for d in judged) >= 0.8 * len(judged)
        if name == "quality classifier":
            judged = [d for d in gone if d in labels]
            assert sum(1 - labels[d].quality for d in judged) >= 0.8 * len(judged)
        if name == "MinHash near-dedup":
            want = plain_components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
            assert ids(docs) == {i for i, (_, c) in want.items() if i == c}
        if name == "SentencePiece encoding and decoding":
            assert not gone and docs.where("not round_trip").count() == 0
    assert ids(P.run(spark, FOLDER)) == ids(docs)


def test_stages_with_odd_rows(spark, tmp_path):
    for t in ("labels", "benchmark"):
        shutil.copy(f"{FOLDER}/{t}.parquet", tmp_path)
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in EDGE], "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (odd, odd.limit(0)):
        docs = rows
        for _, stage in P.STAGES:
            docs = saved(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.count() <= rows.count()
