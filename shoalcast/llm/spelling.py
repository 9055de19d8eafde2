"""Spelling variants: words one edit apart, found by probing edits against Bloom filters of the vocabulary.

The vocabulary (words with their numbers of occurrences) is counted in the map tasks first, so a word in
every text sends one row a task.  It is written once, with a 64-bit hash of each word that an edit changes
by one term, so the hash of an edited word costs one addition.  The filters are blocked (a word's bits
lie in one 64-bit block) and sharded by word length: a deletion is looked up in the shard below, a
replacement in the shard of the word itself.  An insertion is the deletion of the other word, and a
replacement is generated by one of the two words, the one with the smaller letter there; each pair of near
words is therefore generated once.  Only the probes that the filters let through are shuffled, as (word number,
place, letter, hash), to a join with the vocabulary on the hash; what is left is compared letter by letter,
so results are exact whatever the filters say.

Filters are built by a grouped bit-or and broadcast in passes of at most ``FILTER_BYTES``: a vocabulary
that needs more is cut by hash into more passes.  Forms are followed by pointer doubling; a form has at
least ``RATIO`` times the occurrences of its word, so a chain has at most 28 words and five rounds reach its end.

Null and empty texts hold no word, and an empty table gives no rows.  Words and texts may have any length: texts
are read word by word, and long words are probed in slices.  Repeated rows are counted each.  A row without a
doc_id has no hash, so its runs keep all letters.  Ties between forms go to the smallest word in code-point
order.  Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalcast.llm.common import U64, mix, u64
from shoalcast.session import cut_lineage, drop_written

# Fixed by contract: runs of these letters are words, of so many letters and occurrences at least.
RUN = re.compile("[A-Za-z\u00c0-\u00ff]+")
# What words are made of once A-Z are lower-cased.
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], dtype=np.int64)
LOWER = {upper: upper + 32 for upper in range(0x41, 0x5B)}
SHORTEST, RAREST, RATIO = 6, 5, 5
SLIP = 199

BITS = 16  # of filter for each word
SHARDS = 64  # words longer than this share a shard
FILTER_BYTES = 64 << 20
HELD_WORDS = 200_000
PROBES_AT_ONCE = 1 << 20
PROBES_PER_TASK = 4 << 20
BASE = 0x9E6C63D0876A9A47 | 1
INVERSE = pow(BASE, -1, 1 << 64)
PLACE = U64(63)


# Words ---------------------------------------------------------------------------------


def slipped(doc_id, run: str, every: int = SLIP) -> str:
    """The run without one letter where ``every`` divides the crc32 of '<doc_id>:<run>'."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if doc_id is None or h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(shortest: int, every: int):
    """Map batches of (doc_id, text) to (word, n), combined over many texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = RUN.finditer(text.as_py() or "")
                for letters, n in Counter(map(re.Match.group, found)).items():
                    if len(letters) >= shortest:
                        word = slipped(doc, letters.lower() if letters.isascii() else letters.translate(LOWER), every)
                        if len(word) >= shortest:
                            held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
        if held:
            yield out()

    return run


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST, every: int = SLIP) -> DataFrame:
    """(word, n) of the words of all texts that are long and frequent enough."""
    counted = docs.select("doc_id", "text").mapInArrow(word_counts(shortest, every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rarest)


# Hashes and filters --------------------------------------------------------------------


def powers(n: int) -> np.ndarray:
    out = np.full(n + 1, U64(BASE), dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def term(letters: np.ndarray) -> np.ndarray:
    """What a letter adds to a word's sum, before its place's power."""
    return mix(letters.astype(U64) + U64(0x9E3779B97F4A7C15))


def codes(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le"), np.uint32)


def final(total: np.ndarray, length: int) -> np.ndarray:
    return mix(total + u64(length * 0xD6E8FEB86659FD93))


def word_hash(word: str) -> int:
    letters = codes(word)
    total = (term(letters) * powers(len(letters))[:-1]).sum(dtype=U64, keepdims=True)
    return int(final(total, len(letters)).view(np.int64)[0])


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, word, n) with the word's hash, its shard and its mask in the filter."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        hashes = np.array([word_hash(w) for w in words], np.int64)
        shard = np.array([min(len(w), SHARDS) for w in words], np.int32)
        columns = [batch.column("id"), batch.column("word"), batch.column("n"), pa.array(hashes), pa.array(shard), pa.array(masks(hashes.view(U64)).view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "word", "n", "hash", "shard", "mask"])


def masks(hashes: np.ndarray) -> np.ndarray:
    """Four bits of a 64-bit block, from other bits of the hash than those that choose the block."""
    spread = mix(hashes ^ U64(0xA0761D6478BD642F))
    out = np.zeros(len(hashes), U64)
    for j in range(4):
        out |= U64(1) << ((spread >> U64(6 * j)) & PLACE)
    return out


class Filters:
    """The filter blocks of one pass: for each shard those of the words whose hash falls in its part.

    A block's number is ``(hash >> 16) % blocks``; ``parts`` of (part, of) keep the words with
    ``hash mod of == part``, by the low 16 bits.
    """

    def __init__(self, shards: dict[int, tuple[int, int, np.ndarray]]):
        self.shards = shards

    def passed(self, shard: int, hashes: np.ndarray) -> np.ndarray:
        if shard not in self.shards:
            return np.zeros(0, np.int64)
        part, of, blocks = self.shards[shard]
        at = np.flatnonzero((hashes & U64(0xFFFF)) % U64(of) == part) if of > 1 else np.arange(len(hashes))
        probe = hashes[at]
        mask = masks(probe)
        block = blocks[((probe >> U64(16)) % U64(len(blocks))).astype(np.int64)]
        return at[block & mask == mask]


def block_count(words: int) -> int:
    return max(1, -(-words * BITS // 64))


def passes(words: dict[int, int], most: int) -> list[dict[int, tuple[int, int, int]]]:
    """Shards dealt to passes of at most ``most`` bytes of filter: {shard: (part, of, blocks)} for each."""
    out: list[dict[int, tuple[int, int, int]]] = []
    room = 0
    for shard, n in sorted(words.items()):
        of = -(-block_count(n) * 8 // most)
        blocks = block_count(-(-n // of))
        for part in range(of):
            if not out or of > 1 or blocks * 8 > room:
                out.append({})
                room = most
            out[-1][shard] = (part, of, blocks)
            room -= blocks * 8
    return out


def built(words: DataFrame, plan: dict[int, tuple[int, int, int]]) -> Filters:
    """The filters of one pass; their blocks, at most FILTER_BYTES, come to the driver."""
    mine = words.sparkSession.createDataFrame([(s, *x) for s, x in plan.items()], "shard int, part int, of int, blocks long")
    low, high = F.col("hash").bitwiseAND(0xFFFF), F.shiftrightunsigned("hash", 16)
    placed = words.join(F.broadcast(mine), "shard").where(low % F.col("of") == F.col("part"))
    bits = placed.groupBy("shard", (high % F.col("blocks")).alias("block")).agg(F.bit_or("mask").alias("bits")).toArrow()
    shard, block, value = (bits.column(c).to_numpy() for c in ("shard", "block", "bits"))
    out = {}
    for s, (part, of, blocks) in plan.items():
        filled = np.zeros(blocks, U64)
        filled[block[shard == s]] = value[shard == s].view(U64)
        out[s] = (part, of, filled)
    return Filters(out)


# Probes --------------------------------------------------------------------------------


def probes(sent):
    """Map (id, word) to the edits that the filters let through: (id, at, letter, hash); letter 0 deletes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: Filters = sent.value
        terms = term(LETTERS)

        def edits(ids: np.ndarray, letters: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Of words of one length, a row of ``letters`` each."""
            n, length = letters.shape
            power = powers(length)
            value = term(letters.reshape(-1)).reshape(n, length) * power[:length]
            total = value.sum(axis=1, dtype=U64)
            before = np.cumsum(value, axis=1, dtype=U64) - value
            for first in range(0, length, max(1, PROBES_AT_ONCE // (n * len(LETTERS)))):
                at = np.arange(first, min(length, first + max(1, PROBES_AT_ONCE // (n * len(LETTERS)))))
                shorter = before[:, at] + (total[:, None] - before[:, at] - value[:, at]) * U64(INVERSE)
                hashes = final(shorter, length - 1).reshape(-1)
                yield from found(ids, at, None, hashes, filters.passed(min(length - 1, SHARDS), hashes))
                changed = (total[:, None] - value[:, at])[:, :, None] + terms[None, None, :] * power[at][None, :, None]
                larger = LETTERS[None, None, :] > letters[:, at].astype(np.int64)[:, :, None]
                place = np.flatnonzero(larger.reshape(-1))
                hashes = final(changed.reshape(-1)[place], length)
                kept = filters.passed(min(length, SHARDS), hashes)
                yield from found(ids, at, LETTERS, hashes, kept, place)

        def found(ids, at, alphabet, hashes, kept, place=None):
            if not len(kept):
                return
            where = kept if place is None else place[kept]
            wide = 1 if alphabet is None else len(alphabet)
            letter = np.zeros(len(kept), np.int64) if alphabet is None else alphabet[where % wide]
            spot = where // wide
            columns = [ids[spot // len(at)], at[spot % len(at)].astype(np.int32), letter.astype(np.int32), hashes[kept].view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "at", "letter", "hash"])

        for batch in batches:
            by_length: dict[int, list[int]] = {}
            words, ids = batch.column("word").to_pylist(), batch.column("id").to_numpy()
            for i, word in enumerate(words):
                by_length.setdefault(len(word), []).append(i)
            for length, rows in by_length.items():
                step = max(1, PROBES_AT_ONCE // (length * len(LETTERS)))
                for first in range(0, len(rows), step):
                    some = rows[first : first + step]
                    yield from edits(ids[some], np.stack([codes(words[i]) for i in some]))

    return run


def near_pairs(words: DataFrame, most: int = FILTER_BYTES) -> list[DataFrame]:
    """(id, other) once for each two words of ``words`` (id, word, n, hash, shard, mask; written) one edit
    apart: a written table for each pass."""
    spark = words.sparkSession
    sizes = words.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("word")).alias("letters")).collect()
    tasks = sum(r["letters"] for r in sizes) * len(LETTERS) // PROBES_PER_TASK + 1
    right = words.select("hash", F.col("id").alias("other"), F.col("word").alias("other_word"))
    out = []
    for plan in passes({r["shard"]: r["n"] for r in sizes}, most):
        sent = spark.sparkContext.broadcast(built(words, plan))
        dealt = words.select("id", "word").repartition(tasks, "id")
        met = dealt.mapInArrow(probes(sent), "id long, at int, letter int, hash long").join(right, "hash")
        # Equal hashes are not yet equal words.
        own = met.join(words.select("id", "word"), "id")
        letter = F.when(F.col("letter") > 0, F.char("letter")).otherwise("")
        edited = F.concat(F.substr("word", F.lit(1), F.col("at")), letter, F.expr("substr(word, at + 2)"))
        out.append(cut_lineage(own.where(edited == F.col("other_word")).select("id", "other").distinct()))
        sent.destroy()
    return out


# Forms ---------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word of ``forms`` (word, form): where following forms ends."""
    links = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = cut_lineage(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        drop_written(links)
        links = stepped
        if not links.where("moved").limit(1).count():
            return links.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO, most: int = FILTER_BYTES) -> DataFrame:
    """One row for each row of ``words`` (word, n; distinct words): word, n, n_near, form, form_n, root."""
    ids = words.select(F.monotonically_increasing_id().alias("id"), "word", "n")
    table = cut_lineage(ids.mapInArrow(numbered, "id long, word string, n long, hash long, shard int, mask long"))
    pairs = near_pairs(table, most)
    both = table.sparkSession.createDataFrame([], "id long, other long")
    for part in pairs:
        both = both.union(part).union(part.select("other", "id"))
    other = table.select(F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    counted = both.join(other, "other").groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best)
    is_form = -F.col("best.n") >= ratio * F.col("n")
    joined = table.join(counted, "id", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"),
        F.when(is_form, -F.col("best.n")).alias("form_n"),
    )
    joined = cut_lineage(joined)
    ends = roots(joined.where(F.col("form").isNotNull()))
    drop_written(table, *pairs)
    return joined.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group(docs: DataFrame) -> DataFrame:
    """The words of ``docs`` (doc_id, text) with their near words, forms and roots."""
    return variants(vocabulary(docs))
