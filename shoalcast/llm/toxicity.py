"""Toxicity scores from a counterfactually regularised logistic classifier.

Features are the presence of hashed words and word beginnings.  Every identity term of a labelled text is
swapped for the others of its group and for none, and the squared change of the score is
penalised, so a mention of a group carries no weight of its own.  An L1 penalty keeps the model
sparse.  The fit reads a bounded sample of labelled rows (``max_labelled``); scoring reads every whole text.

Null and empty texts get the score of the bias.  Labels that are null are ignored, a document labelled
twice counts as toxic if any label says so, repeated rows are scored alike, other columns pass by.  Without
labels of both kinds every score is the smoothed share of toxic labels (0.5 without any).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from shoalcast.llm.common import ALNUM_PARTED, LOWER, Words, chunks, hash_rate, utf8
from shoalcast.session import cut_lineage

BITS = 18
PREFIXES = (4, 5)
MAX_LABELLED = 6000
SPARSITY = 1e-3
PRIOR = 2.0
COUNTERFACTUAL = 1.0
ROUNDS = 250
# Entries of the sample whose products are held at a time.
BLOCK = 1 << 18

# Terms of one group stand in for each other; the empty one removes the mention.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys", "transgender people", ""),
    ("woman", "man", "girl", "boy", "transgender person", ""),
    ("gay", "straight", "lesbian", "bisexual", "queer", ""),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", ""),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", ""),
    ("black", "white", "asian", "latino", "african", "european", ""),
    ("immigrants", "refugees", "natives", "foreigners", ""),
    ("disabled", "deaf", "blind", "elderly", "young", ""),
    ("frauen", "männer", "muslime", "christen", "juden", "ausländer", ""),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", ""),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", ""),
)


def swaps(groups: tuple[tuple[str, ...], ...]) -> tuple[re.Pattern | None, dict[str, list[str]]]:
    others = {term: [t for t in group if t != term] for group in groups for term in group if term}
    if not others:
        return None, {}
    longest_first = sorted(others, key=len, reverse=True)
    return re.compile(r"\b(?:" + "|".join(map(re.escape, longest_first)) + r")\b", re.IGNORECASE), others


def counterfactuals(text: str, pattern: re.Pattern | None, others: dict[str, list[str]]) -> list[str]:
    """The text with all its identity terms swapped, once for each place in their groups."""
    if pattern is None or not pattern.search(text):
        return []
    most = max(len(others[m.group().lower()]) for m in pattern.finditer(text))

    def nth(n: int):
        return lambda m: (found := others[m.group().lower()])[n % len(found)]

    return [pattern.sub(nth(n), text) for n in range(most)]


def buckets(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words of a batch, and the text of each."""
    words = Words(LOWER[data], offsets, ALNUM_PARTED)
    shift = np.uint64(64 - bits)
    found = [words.hashes() >> shift] + [words.hashes(p) >> shift for p in PREFIXES]
    return np.concatenate(found).astype(np.int64), np.tile(words.text, len(found))


def present(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    bucket, text = buckets(data, offsets, bits)
    key = np.unique(text << bits | bucket)
    return key & ((1 << bits) - 1), key >> bits


def features(bits: int, groups):
    """Map (toxic, text) to rows (toxic, features, changes): changes lists, for each swap, the features
    lost as -1 - feature and those gained as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, others = swaps(groups)
        for batch in chunks(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            feature, text = present(data, offsets, bits)
            bounds = np.searchsorted(text, np.arange(batch.num_rows + 1))
            own = [feature[bounds[i] : bounds[i + 1]] for i in range(batch.num_rows)]
            changes = []
            for i, value in enumerate(batch.column("text").to_pylist()):
                mine = []
                for other in counterfactuals(value or "", pattern, others):
                    raw = np.frombuffer(other.encode(), np.uint8)
                    swapped, _ = present(raw, np.array([0, len(raw)]), bits)
                    mine.append(np.concatenate([-1 - np.setdiff1d(own[i], swapped), np.setdiff1d(swapped, own[i])]).tolist())
                changes.append(mine)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic"),
                    pa.array([x.tolist() for x in own], pa.list_(pa.int32())),
                    pa.array(changes, pa.list_(pa.list_(pa.int32()))),
                ],
                names=["toxic", "features", "changes"],
            )

    return run


def log_odds(y, feature, row, size, prior: float) -> np.ndarray:
    """How much likelier a text of one class has each feature, shrunk to zero for rare ones."""
    toxic = np.bincount(feature, y[row], size)
    clean = np.bincount(feature, minlength=size) - toxic
    return np.log((toxic + prior) / (y.sum() + 2 * prior)) - np.log((clean + prior) / (len(y) - y.sum() + 2 * prior))


def summed_by(key: np.ndarray, size: int, most: int = BLOCK):
    """The order that brings equal keys together, and a function to sums by key from one that gives the values
    of a stretch of that order; about ``most`` values are held at a time."""
    # Four bytes an entry: keys are features, rows or pairs, and a sample has no more entries than that.
    order = np.argsort(key, kind="stable").astype(np.int32)
    counts = np.bincount(key, minlength=size)
    some = np.flatnonzero(counts)
    stops = np.cumsum(counts[some])
    starts = stops - counts[some]
    blocks = np.unique(np.searchsorted(stops, np.arange(0, len(key), most), "right")) if len(some) else np.zeros(0, np.int64)
    blocks = list(zip(blocks, [*blocks[1:], len(some)]))

    def sums(values: Callable[[slice], np.ndarray]) -> np.ndarray:
        out = np.zeros(size)
        for first, last in blocks:
            at = starts[first]
            out[some[first:last]] = np.add.reduceat(values(slice(at, stops[last - 1])), starts[first:last] - at)
        return out

    return order, sums


def fit_logistic(y, feature, row, change, sign, pair, size, sparsity, counterfactual, rounds, prior=PRIOR):
    """Accelerated proximal gradient on class-balanced log loss + L1 + mean squared score change of the
    swaps, over features scaled by their log odds."""
    n, pairs = len(y), int(pair.max()) + 1 if len(pair) else 0
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, n - y.sum()))
    scale = log_odds(y, feature, row, size, prior)

    # The same entries in two orders: sums over runs are much quicker than scattered ones.
    order, row_sums = summed_by(row, n)
    feature_of_row = feature[order]
    order, feature_sums = summed_by(feature, size)
    feature_of_feature, row_of_feature = feature[order], row[order]
    order, pair_sums = summed_by(pair, pairs)
    change_of_pair, sign_of_pair = change[order], sign[order]
    order, change_sums = summed_by(change, size)
    change_of_change, sign_of_change, pair_of_change = change[order], sign[order], pair[order]
    del order

    def total(w):
        scaled = scale * w
        return row_sums(lambda some: scaled[feature_of_row[some]])

    def slope_of(error, w):
        out = feature_sums(lambda some: scale[feature_of_feature[some]] * error[row_of_feature[some]])
        if pairs:
            moved = pair_sums(lambda some: sign_of_pair[some] * scale[change_of_pair[some]] * w[change_of_pair[some]])
            moved = change_sums(lambda some: sign_of_change[some] * scale[change_of_change[some]] * moved[pair_of_change[some]])
            out += counterfactual * moved / pairs
        return out

    # The largest curvature, by power iteration.
    direction, steepest = np.abs(scale) / max(1e-12, np.linalg.norm(scale)), 1.0
    for _ in range(12):
        ahead = slope_of(0.25 * weight * total(direction), direction)
        steepest = max(np.linalg.norm(ahead), 1e-9)
        direction = ahead / steepest
    step = 0.8 / (steepest + 0.25)
    w, bias, w0, b0 = np.zeros(size), 0.0, np.zeros(size), 0.0
    for i in range(rounds):
        push = i / (i + 3)
        z, zb = w + push * (w - w0), bias + push * (bias - b0)
        error = weight * (1 / (1 + np.exp(-np.clip(zb + total(z), -30, 30))) - y)
        w0, b0 = w, bias
        w = z - step * slope_of(error, z)
        w = np.sign(w) * np.maximum(np.abs(w) - step * sparsity, 0)
        bias = zb - step * error.sum()
    return w * scale, bias


def fit(bits: int, sparsity: float, counterfactual: float, rounds: int):
    """Map the sampled feature rows, in one task, to (feature, weight); feature -1 is the bias."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        y = table.column("toxic").to_numpy().astype(float) if table.num_rows else np.zeros(0)
        if not len(y) or y.min() == y.max():
            share = (y.sum() + 1) / (len(y) + 2)
            kept, weights, bias = np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share)))
        else:
            lists = table.column("features").combine_chunks()
            feature = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(y), dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
            swapped = table.column("changes").combine_chunks().flatten()
            signed = swapped.flatten().to_numpy(zero_copy_only=False)
            change, sign = np.where(signed >= 0, signed, -1 - signed), np.where(signed >= 0, 1, -1).astype(np.int8)
            pair = np.repeat(np.arange(len(swapped), dtype=np.int32), swapped.value_lengths().to_numpy(zero_copy_only=False))
            # What occurs in one or two texts says nothing of others.
            size = 1 << bits
            known = np.bincount(feature, minlength=size) >= 3
            used = known[feature]
            feature, row = feature[used], row[used]
            del held[:], table, lists, swapped, signed, used
            w, bias = fit_logistic(y, feature, row, change, sign, pair, size, sparsity, counterfactual, rounds)
            kept = np.flatnonzero(w)
            weights = w[kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(kept, -1).astype(np.int32)), pa.array(np.append(weights, bias))], names=["feature", "weight"]
        )

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = MAX_LABELLED,
    bits: int = BITS,
    groups=IDENTITY_GROUPS,
    sparsity: float = SPARSITY,
    counterfactual: float = COUNTERFACTUAL,
    rounds: int = ROUNDS,
) -> tuple[np.ndarray, float]:
    """Weights and bias from the texts of ``docs`` that ``labels`` (doc_id, toxic) marks; about
    ``max_labelled`` rows of each class are read, chosen by a hash of the id."""
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {int(r[0]): r[1] for r in marked.where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    rate = F.lit(0.0)
    for value, n in sizes.items():
        rate = F.when(F.col("toxic") == value, F.lit(min(1.0, max_labelled / n))).otherwise(rate)
    chosen = marked.where(hash_rate("doc_id", rate))
    # At most about 2 * max_labelled rows of two numbers.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("toxic").cast("int").alias("toxic"), "text")
    rows = texts.mapInArrow(features(bits, groups), "toxic int, features array<int>, changes array<array<int>>")
    # Written first, or the one task that fits would scan all documents too.
    fitted = cut_lineage(rows).coalesce(1).mapInArrow(fit(bits, sparsity, counterfactual, rounds), "feature int, weight double").collect()
    weights, bias = np.zeros(1 << bits), 0.0
    for feature, weight in fitted:
        if feature < 0:
            bias = weight
        else:
            weights[feature] = weight
    return weights, bias


def scorer(weights: np.ndarray, bias: float, columns: list[str]):
    """Append ``score`` to batches; only features with a weight are made distinct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = int(len(weights)).bit_length() - 1
        live = weights != 0
        for batch in chunks(batches, "__text"):
            data, offsets = utf8(batch.column("__text"))
            bucket, text = buckets(data, offsets, bits)
            told = live[bucket]
            key = np.unique(text[told] << bits | bucket[told])
            total = bias + np.bincount(key >> bits, weights[key & ((1 << bits) - 1)], batch.num_rows)
            score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(score)], names=[*columns, "__score"])

    return run


def score(docs: DataFrame, model: tuple[np.ndarray, float], out: str = "score") -> DataFrame:
    """``docs`` with the probability in ``out`` (replaced if there already)."""
    base = docs.drop(out)
    read = base.withColumn("__text", F.col("text"))
    schema = StructType([*base.schema.fields, StructField("__score", DoubleType())])
    return read.mapInArrow(scorer(*model, base.columns), schema).withColumnRenamed("__score", out)
