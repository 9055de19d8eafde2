import random

import corpus_pipeline
from pyspark.sql import functions as F


def test_stages_keep_columns_and_drop_only_what_they_should(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("band", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert 0 < len(rows) <= docs.count()
        assert all(r["n_chars"] == len(r["text"]) for r in rows), name
        docs = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in rows}


def test_near_duplicates_are_decided_row_by_row(spark):
    rnd = random.Random(5)
    texts = [" ".join(f"word{rnd.randrange(500)}" for _ in range(40)) for _ in range(8)]
    rows = [(i, texts[i]) for i in range(6)]
    rows += [(None, texts[0])] * 3 + [(None, texts[6])] * 4 + [(1, texts[1])] * 2 + [(0, texts[7]), (9, texts[2]), (2, texts[3]), (7, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    best = {}
    for doc, text in rows:
        key = (doc is None, doc or 0)
        best[text] = min(best.get(text, key), key)
    expected = [(None if none else doc, text) for text, (none, doc) in best.items() if text is not None] + [(7, None), (None, None)]
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_columns_of_any_name_pass_every_stage(spark):
    """The names the operators use inside, on the caller's side."""
    sf_dir = "/root/testdata/sf0.001"
    names = ["others", "row", "cut", "before", "score", "__text", "__spans", "__items", "__words", "__cut", "__found", "__score", "a.b"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    docs = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[docs.columns.index(n)] == i for r in rows for i, n in enumerate(names)), name


def test_empty_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir) if _ == "packing" else spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
    assert docs.count() == 0
