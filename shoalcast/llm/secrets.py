"""Secret scan: candidate strings judged by a random forest, in DataFrame functions only.

One regex pass cuts each text into candidates and what lies between: long runs of characters with a
digit, behind the last ``=`` of a run and without its closing dots, and whatever is assigned to the name
of a credential, of any length and characters.  A candidate's features are its
length, its transitions between kinds of characters, how much of it the corpus dictionary covers, how
like a path it is and its neighbouring words.  The forest is fitted on labelled findings (given, or
taken from the corpus by rules that are sure of themselves), on a bounded sample of them
(``max_findings`` distinct ones of each class, weighted by their copies), and then written as one SQL expression, so scoring stays
inside the row: no join, no shuffle, and the candidates of a row never leave it.

Null and empty texts have no candidate.  Repeated rows are judged alike, a text as long as it is, other
columns pass by.  Without findings of both classes the rules alone decide.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalcast.llm.common import hash_rate
from shoalcast.session import cut_lineage

MAX_FINDINGS = 5000
TREES = 20
DEPTH = 5
VERDICT = 0.5
MASK = "[SECRET]"
DICTIONARY_BITS = 16

BODY = r"A-Za-z0-9_+/~\-"
KEY_BLOCK = r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*+-----END [A-Z ]*PRIVATE KEY-----"
# A run behind the last "=" that has characters behind it; padding belongs to it, closing dots do not.
LONG = rf"(?<![{BODY}])(?=[{BODY}][{BODY}.]{{15}})(?<![{BODY}][.])(?=[{BODY}.]*[0-9])[{BODY}.]{{16,}}(?<![.])=*+(?![.]*+[{BODY}])"
# The name of a credential up to the value given to it, and the value: quoted, or as far as a word goes.
NAME = r"(?=[tspacbTSPACB])(?i:token|secret|passw(?:or)?d|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|authorization|auth(?![a-z])|bearer)(?:[_-][\w-]{0,24}|[A-Z]\w{0,24})?"
SCHEME = r"(?:(?i:bearer|basic|token)\s+)?"
GIVEN = rf"""{NAME}["'`]?\s{{0,4}}(?:=>|:=|={{1,3}}|:)\s{{0,4}}["'`]?{SCHEME}"""
WORD = r"""[^\s\x00-\x1f"'`,;<>&]"""
QUOTED = "|".join(rf"(?<={q})[^{q}\x00-\x1f]++(?={q})" for q in "\"'`")
VALUE = rf"{KEY_BLOCK}|{QUOTED}|(?![.:)\]}}]){WORD}+(?:&(?!\w{{1,32}}=){WORD}+){{0,64}}(?<![.:)\]}}])"
CANDIDATE = rf"({GIVEN})({VALUE})|({KEY_BLOCK}|{LONG})"
# Fixed formats that issuers publish.
ISSUED = rf"^(?:AKIA[0-9A-Z]{{16}}|gh[pousr]_[A-Za-z0-9]{{36,}}|xox[abprs]-[A-Za-z0-9-]{{10,}}|sk-[A-Za-z0-9_-]{{20,}}|AIza[A-Za-z0-9_-]{{35}}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+|{KEY_BLOCK})$"
CREDENTIAL = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential)"
ASSIGNED = rf"""[=:>]\s*["'`]?{SCHEME}$"""
# What stands right before the candidate is the name of a credential.
NAMED = rf"""{NAME}["'`]?\s{{0,4}}(?:=>|:=|={{1,3}}|:|(?i:is))?\s{{0,4}}["'`]?{SCHEME}$"""
MARK, ESCAPE = "\u0001", "\u0002"
FEATURES = ("length", "transitions", "variety", "digits", "upper", "dictionary", "path", "credential", "assigned", "address")


def pieces(text: Column) -> Column:
    """The text cut at its candidates: even places lie between them, odd places are candidates."""
    safe = F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "\u0004")), F.lit(MARK), F.lit(ESCAPE + "\u0003"))
    cut = F.split(F.regexp_replace(safe, CANDIDATE, f"$1{MARK}$2$3{MARK}"), MARK, -1)

    def plain(p: Column) -> Column:
        return F.replace(F.replace(p, F.lit(ESCAPE + "\u0003"), F.lit(MARK)), F.lit(ESCAPE + "\u0004"), F.lit(ESCAPE))

    return F.transform(cut, plain)


def share(pattern: str, text: Column) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double") / F.greatest(F.char_length(text), F.lit(1))


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(1 << DICTIONARY_BITS)).cast("int")


def dictionary(docs: DataFrame) -> bytes:
    """For each bucket of hashed words, whether the corpus uses it far more than the mean: counted over
    the documents that hold a word, in all documents; its size does not depend on the corpus."""
    words = F.array_distinct(F.split(F.lower("text"), r"\P{L}+"))
    counts = (
        docs.select(F.explode(words).alias("word"))
        .where(F.char_length("word") >= 3)
        .groupBy(bucket(F.col("word")).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = counts.collect()
    mean = sum(r["n"] for r in rows) / (1 << DICTIONARY_BITS)
    known = bytearray(1 << DICTIONARY_BITS)
    for r in rows:
        known[r["bucket"]] = r["n"] >= max(5, 4 * mean)
    return bytes(known)


def described(cut: Column, known: bytes) -> Column:
    """The candidates of a cut text with their features, in order."""
    table = F.lit(known)

    def one(i: Column) -> Column:
        value = F.get(cut, i)
        left = F.right(F.get(cut, i - 1), F.lit(32))
        right = F.left(F.get(cut, i + 1), F.lit(8))
        runs = F.regexp_extract_all(F.lower(value), F.lit(r"([a-z]{3,})"), F.lit(1))
        covered = F.aggregate(
            runs,
            F.lit(0),
            lambda n, r: n + F.when(F.substring(table, bucket(r) + 1, F.lit(1)) == F.lit(b"\x01"), F.char_length(r)).otherwise(0),
        )
        length = F.char_length(value)
        kinds = r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])"
        return F.struct(
            value.alias("value"),
            i.alias("place"),
            left.alias("left"),
            length.cast("double").alias("length"),
            share(kinds, value).alias("transitions"),
            (F.size(F.array_distinct(F.split(value, ""))) / length).alias("variety"),
            share("[0-9]", value).alias("digits"),
            share("[A-Z]", value).alias("upper"),
            (covered / length).alias("dictionary"),
            share(r"[/.~_-]", value).alias("path"),
            F.regexp_like(left, F.lit(CREDENTIAL)).cast("double").alias("credential"),
            F.regexp_like(left, F.lit(ASSIGNED)).cast("double").alias("assigned"),
            (F.regexp_like(left, F.lit("(?:://|@|www[.])[^ ]*$")) | F.startswith(right, F.lit("@"))).cast("double").alias("address"),
        )

    return F.transform(F.filter(F.sequence(F.lit(0), F.size(cut) - 1), lambda i: i % 2 == 1), one)


def sure_label(c: Column) -> Column:
    """1 for findings that are secrets beyond doubt, 0 for those that are not, null between.

    What names a credential, or is given to one, is never sure to be none.
    """
    issued = F.regexp_like(c["value"], F.lit(ISSUED))
    mixed = (c["length"] >= 20) & (c["digits"] > 0) & (c["variety"] >= 0.2) & (c["dictionary"] < 0.5) & (c["path"] < 0.1)
    short = (c["length"] >= 8) & (c["digits"] > 0) & (c["variety"] >= 0.5) & (c["dictionary"] < 0.5) & (c["path"] < 0.1) & F.regexp_like(c["value"], F.lit(r"^(?=.*[A-Za-z])\S+$"))
    named = (c["credential"] == 1) & (c["assigned"] == 1)
    names = F.regexp_like(c["left"], F.lit(NAMED)) | F.regexp_like(c["value"], F.lit(CREDENTIAL))
    return (
        F.when(issued, 1)
        .when(named & (mixed | short) & (c["address"] == 0), 1)
        .when(names, None)
        .when((c["address"] == 1) | (c["path"] >= 0.1) | (c["dictionary"] >= 0.5) | ((c["credential"] == 0) & (c["assigned"] == 0)), 0)
    )


def candidates(docs: DataFrame, known: bytes) -> DataFrame:
    """``docs`` with __cut (the pieces) and __found (the candidates with their features)."""
    cut = docs.withColumn("__cut", pieces(F.coalesce("text", F.lit(""))))
    return cut.withColumn("__found", F.when(F.size("__cut") > 1, described(F.col("__cut"), known)))


def labelled_findings(docs: DataFrame, known: bytes) -> DataFrame:
    """Findings of the corpus that the rules label, with their features."""
    some = candidates(docs.select("text"), known).where("__found is not null")
    rows = some.select(F.explode("__found").alias("c"))
    return rows.select("c.value", "c.left", *(f"c.{f}" for f in FEATURES), sure_label(F.col("c")).alias("label")).where("label is not null")


def fit_forest(findings: DataFrame, max_findings: int = MAX_FINDINGS, trees: int = TREES, depth: int = DEPTH) -> str | None:
    """The forest fitted on labelled findings, as text; null without findings of both classes."""
    # Copies of a finding are one row with their number.  Written first: the steps below read it many times, and in one task.
    findings = cut_lineage(findings.groupBy("value", "left", *FEATURES, "label").agg(F.count(F.lit(1)).cast("double").alias("copies")))
    sizes = {r["label"]: r["count"] for r in findings.groupBy("label").count().collect()}
    if set(sizes) != {0, 1}:
        return None
    rate = F.when(F.col("label") == 1, min(1.0, max_findings / sizes[1])).otherwise(min(1.0, max_findings / sizes[0]))
    # One order of rows whatever the partitions: the same findings give the same forest.
    sample = findings.where(hash_rate(F.concat_ws(" ", "left", "value"), rate)).coalesce(1).sortWithinPartitions("value", "left", *FEATURES)
    rows = sample.select(array_to_vector(F.array(*FEATURES)).alias("features"), F.col("label").cast("double").alias("label"), "copies")
    if rows.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, maxMemoryInMB=64, weightCol="copies").fit(rows).toDebugString


def tree_expression(lines: list[str], c: Column) -> Column:
    """One tree as nested conditions; takes its lines off the front."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return F.lit(float(line.split(":")[1]))
    feature, bound = re.match(r"If \(feature (\d+) <= ([-0-9.E]+)\)", line).groups()
    below = tree_expression(lines, c)
    lines.pop(0)
    above = tree_expression(lines, c)
    return F.when(c[FEATURES[int(feature)]] <= float(bound), below).otherwise(above)


def probability(forest: str | None, c: Column) -> Column:
    """Share of the trees that vote for a secret; the rules' own verdict without a forest."""
    if forest is None:
        return F.coalesce(sure_label(c), F.lit(0)).cast("double")
    votes = []
    for part in re.split(r"\n\s*Tree \d+ \(weight [^)]*\):\n", forest)[1:]:
        votes.append(tree_expression(part.rstrip().split("\n"), c))
    total = votes[0]
    for vote in votes[1:]:
        total = total + vote
    return total / len(votes)


def judge(docs: DataFrame, forest: str | None, known: bytes, verdict: float = VERDICT) -> DataFrame:
    """``docs`` with __cut and __found; each candidate there has a probability and a verdict."""
    frame = candidates(docs, known)

    def one(c: Column) -> Column:
        return F.struct(c["place"].alias("place"), c["value"].alias("value"), probability(forest, c).alias("probability"))

    return frame.withColumn("__found", F.transform("__found", one))


def findings(docs: DataFrame, forest: str | None, known: bytes, verdict: float = VERDICT) -> DataFrame:
    """One row for each candidate: doc_id, start and length in characters, sha256 of the candidate,
    probability, is_secret."""
    some = judge(docs.select("doc_id", "text"), forest, known).where("__found is not null")
    lengths = F.transform("__cut", lambda p: F.char_length(p))
    rows = some.select("doc_id", F.monotonically_increasing_id().alias("row"), lengths.alias("lengths"), "__found")
    judged = F.transform(
        F.sequence(F.lit(0), F.size("lengths") - 1),
        lambda i: F.struct(
            F.get("lengths", i).alias("length"),
            F.when(i % 2 == 1, F.sha2(F.get("__found", (i / 2).cast("int"))["value"], 256)).alias("sha256"),
            F.when(i % 2 == 1, F.get("__found", (i / 2).cast("int"))["probability"]).alias("probability"),
        ),
    )
    spread = rows.select("doc_id", "row", F.posexplode(judged).alias("pos", "p"))
    before = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = spread.withColumn("start", F.coalesce(F.sum("p.length").over(before), F.lit(0)))
    return placed.where("pos % 2 = 1").select(
        "doc_id",
        F.col("start").cast("long").alias("start"),
        F.col("p.length").cast("long").alias("length"),
        F.col("p.sha256").alias("sha256"),
        F.col("p.probability").alias("probability"),
        (F.col("p.probability") >= verdict).alias("is_secret"),
    )


def redacted(docs: DataFrame, forest: str | None, known: bytes, verdict: float = VERDICT, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask``; null texts stay null."""
    frame = judge(docs, forest, known)
    found = F.col("__found")

    def part(p: Column, i: Column) -> Column:
        hidden = (i % 2 == 1) & (F.get(found, (i / 2).cast("int"))["probability"] >= verdict)
        return F.when(hidden, F.lit(mask)).otherwise(p)

    text = F.when(F.exists(found, lambda c: c["probability"] >= verdict), F.array_join(F.transform("__cut", part), "")).otherwise(F.col("text"))
    return frame.withColumn("text", text).drop("__cut", "__found")


def train(docs: DataFrame, max_findings: int = MAX_FINDINGS) -> tuple[str | None, bytes]:
    known = dictionary(docs)
    return fit_forest(labelled_findings(docs, known), max_findings), known
