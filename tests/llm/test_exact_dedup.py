import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from shoalcast.llm import exact_dedup


def brute(rows):
    """(doc_id, keep_id, group_size, kept, text_sha256) of each (doc_id, text)."""
    groups = {}
    for k, (doc, text) in enumerate(rows):
        text = text or ""
        digest = hashlib.sha256(re.sub("[\x20\x09-\x0d]+", "", text).encode()).hexdigest()
        groups.setdefault(digest, []).append((-len(text), doc is None, doc or 0, k, doc))
    out = []
    for digest, members in groups.items():
        first = min(members)
        out += [(m[4], first[4], len(members), m == first, digest) for m in members]
    return out


def spread(rows):
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    rows = [(i, f"text {rnd.randrange(40)} é世") for i in range(300)]
    rows += [(1000 + i, "hot  text") for i in range(400)]  # over HEAVY rows
    rows += [(2000, "hot\ttext\n\x0b\x0c\r "), (2001, "hot text"), (None, "hot          text"), (-5, "hot          text")]
    rows += [(3000, None), (3001, ""), (3002, " \n "), (None, None), (7, rows[7][1]), (7, rows[7][1]), (3003, "x" * 300_000), (3004, "x" * 150_000 + " " + "x" * 150_000)]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "row", 5) for r in rows], "doc_id long, text string, row string, n int").repartition(6)


def test_decisions_equal_brute_force(spark, rows):
    got = [tuple(r) for r in exact_dedup.decide(frame(spark, rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert spread(got) == spread(brute(rows))


@pytest.mark.parametrize(("heavy", "tracked"), [(1, 32), (10**6, 1024)])
def test_every_split_gives_the_same(spark, rows, monkeypatch, heavy, tracked):
    """All digests broadcast as far as the summaries name them, or none."""
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)
    monkeypatch.setattr(exact_dedup, "TRACKED", tracked)
    got = [tuple(r) for r in exact_dedup.decide(frame(spark, rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert spread(got) == spread(brute(rows))


def test_summaries_name_the_frequent_digests(spark, rows):
    slim = exact_dedup.slim_rows(frame(spark, rows).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    named = exact_dedup.frequent_hashes(slim)
    hot = slim.where(F.col("digest") == hashlib.sha256(b"hottext").hexdigest())
    assert hot.join(named, "hash", "left_semi").count() == 403
    assert named.count() <= exact_dedup.BUCKETS * exact_dedup.PER_BUCKET


def test_rows_that_stay_keep_their_columns(spark, rows):
    docs = frame(spark, rows)
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    assert spread((r["doc_id"], r["text"] or "") for r in out.collect()) == spread((rows_[0], rows_[1] or "") for rows_ in stay(rows))


def stay(rows):
    groups = {}
    for k, (doc, text) in enumerate(rows):
        key = re.sub("[\x20\x09-\x0d]+", "", text or "")
        groups.setdefault(key, []).append((-len(text or ""), doc is None, doc or 0, k))
    return [rows[min(members)[3]] for members in groups.values()]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.decide(empty).collect() == []
    assert exact_dedup.deduplicate(empty).collect() == []


def test_no_python_on_the_path(spark, rows):
    plan = exact_dedup.decide(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
