import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from shoalcast.llm import spelling


def brute(rows, rarest=5, shortest=6):
    """The contract word by word, all pairs compared."""
    counts = Counter()
    for doc, text in rows:
        for letters in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in letters)
            h = zlib.crc32(f"{doc}:{low}".encode())
            if doc is not None and h % 199 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= rarest}
    return resolved(words)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def resolved(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, n, len(near[w]), forms[w], words.get(forms[w]), root))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(3)
    base = ["because", "through", "between", "caféteria", "Élèves", "straight", "aaaaaaa", "x" * 90, "thorough"]
    letters = "abetuéÿ"
    rows = []
    for i in range(120):
        words = []
        for _ in range(60):
            w = rnd.choice(base)
            if rnd.random() < 0.3:
                at, c = rnd.randrange(len(w)), rnd.choice(letters)
                w = rnd.choice([w[:at] + c + w[at:], w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :]])
            words.append(w.upper() if rnd.random() < 0.1 else w)
        rows.append((i, rnd.choice([" ", "-", "1"]).join(words)))
    rows += [(None, rows[4][1]), (5, rows[5][1]), (500, None), (501, ""), (502, "12 世界")]
    rows.append((503, " ".join(["because"] * 30_000)))
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(5)


def test_variants_equal_brute_force(docs):
    rows, frame = docs
    expected = brute(rows)
    assert sum(1 for r in expected if r[3]) > 20
    assert result(spelling.group(frame)) == expected


def test_small_filters_take_more_passes_and_change_nothing(docs, spark):
    rows, frame = docs
    words = spelling.vocabulary(frame)
    assert len(spelling.passes({6: 400, 7: 10, 8: 10}, 256)) > 2
    assert result(spelling.variants(words, most=64)) == brute(rows)


def test_chains_reach_their_last_form(spark):
    words = {"aaaaaa": 10, "aaaaab": 50, "aaaabb": 250, "aaabbb": 1250, "aabbbb": 6250, "abbbbb": 31250, "zzzzzzz": 5, "zzzzzz": 24}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = result(spelling.variants(frame))
    assert got == resolved(words)
    assert {r[0]: r[5] for r in got}["aaaaaa"] == "abbbbb"


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group(empty).collect() == []
    assert spelling.group(spark.createDataFrame([(1, "short words only")], "doc_id long, text string")).where(F.col("n") > 0).collect() == []
