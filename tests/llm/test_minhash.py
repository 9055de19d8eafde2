import random

import pytest
from pyspark.sql import functions as F
from shoalcast.llm import minhash


def shingled(text, size=5):
    words = text.lower().split()
    return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_classes(rows, similarity=0.8):
    """Smallest doc_id of the component of each text under similarity of shingle sets."""
    sets = {}
    for doc, text in rows:
        sets.setdefault(frozenset(shingled(text)), []).append(doc)
    nodes = [s for s in sets if s]
    parent = {s: s for s in nodes}

    def root(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    links = 0
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if len(a & b) >= similarity * len(a | b):
                links += 1
                parent[root(a)] = root(b)
    least = {}
    for s in nodes:
        least[root(s)] = min([least.get(root(s), 10**9), *sets[s]])
    return {doc: least[root(s)] for s in nodes for doc in sets[s]}, links


@pytest.fixture(scope="module")
def edits():
    """One text edited more and less, so that similarities spread around the threshold, and unrelated texts."""
    rnd = random.Random(6)
    base = [f"w{rnd.randrange(4000)}" for _ in range(150)]
    rows = []
    for i in range(260):
        words = list(base)
        for _ in range(rnd.randrange(0, 10)):
            words[rnd.randrange(len(words))] = f"w{rnd.randrange(40)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"u{rnd.randrange(3000)}" for _ in range(rnd.randrange(3, 60)))) for i in range(100)]
    return rows


def test_spread_similarities_equal_brute_force(spark, edits):
    expected, links = brute_classes(edits)
    assert 100 < links < 260 * 259 / 2
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(edits, "doc_id long, text string").repartition(4)).collect()}
    same = sum(got[doc] == expected[doc] for doc in expected)
    print(f"recall of classes {same / len(expected):.4f}")
    assert same == len(expected)


def test_rare_shingles_lose_no_link(spark, edits):
    """With every vertex on its own, the rare-shingle join finds each pair that reaches the similarity."""
    sets = {i: shingled(t) for i, t in edits[:120]}
    pairs = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    number = {x: k for k, x in enumerate(sorted(set().union(*sets.values())))}
    table = spark.createDataFrame([(i, [number[x] for x in s]) for i, s in sets.items()], "vertex long, shingles array<int>")
    left = table.select("vertex", F.col("vertex").alias("label"))
    prefixes = minhash.rare_shingles(left, table, 0.8)
    found = {tuple(r) for r in minhash.rare_pairs(prefixes, 0, 1, 0.8).distinct().collect()}
    assert pairs <= found
    assert len(found) < 120 * 119 / 4


def test_likely_keeps_every_key(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SLOTS", 4)
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    ids = rows.where("doc_id % 50 = 0").select("doc_id")
    kept = {r["doc_id"] for r in minhash.likely(rows, ids, "doc_id").collect()}
    assert {i for i in range(0, 1000, 50)} <= kept and len(kept) < 400
