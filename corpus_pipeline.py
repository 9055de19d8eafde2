"""Five stages over ``documents``: toxic texts go, one of each near-duplicate group stays, benchmark
passages and secrets are cut out, what is left is packed.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read as the next one's
docs.  All but the last return the columns they got; ``n_chars`` follows a changed text.  Rows with a
null text pass the filters.  The second stage decides for each row by itself, whatever its doc_id.  Other
columns may have any name; texts may have any length; empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalcast.llm import decontaminate, minhash, packing, secrets, toxicity
from shoalcast.llm.common import table
from shoalcast.llm.queries import toxicity_model
from shoalcast.session import cut_lineage, drop_written

THRESHOLD = 0.7


def narrowed(docs: DataFrame) -> DataFrame:
    """(text, others): the other columns in one, so that their names never meet those an operator adds."""
    return docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("others"))


def restored(frame: DataFrame, docs: DataFrame, text: str = "text", before: str = "text") -> DataFrame:
    """The columns of ``docs`` with ``text`` of a narrowed frame; n_chars follows where it differs from ``before``."""
    out = {"text": F.col(text).alias("text")}
    if "n_chars" in docs.columns and text != before:
        count = F.char_length(text).cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.col(text).eqNullSafe(F.col(before)), F.col("others.n_chars")).otherwise(count).alias("n_chars")
    return frame.select(*[out.get(c, F.col("others").getField(c).alias(c)) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(narrowed(docs), toxicity_model(spark, sf_dir), "score")
    return restored(scored.where(F.col("score") < THRESHOLD), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of a group stays: of the smallest doc_id, one without an id only if none has one."""
    # Written first: the key of a row must not change between reads.
    rows = cut_lineage(narrowed(docs).withColumn("row", F.monotonically_increasing_id()))
    classes, tables = minhash.classes_of(rows.select(F.col("row").alias("doc_id"), "text"))
    found = cut_lineage(classes.select(F.col("doc_id").alias("row"), "class_id"))
    drop_written(*tables)
    ids = rows.select("row", F.col("others.doc_id").alias("doc_id"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"]
    kept = found.join(ids, "row").groupBy("class_id").agg(first.alias("row"))
    gone = cut_lineage(found.join(kept, ["class_id", "row"], "left_anti").select("row"))
    drop_written(found)
    return restored(rows.join(gone, "row", "left_anti"), docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(narrowed(docs), table(spark, sf_dir, "benchmark"))
    text = F.when(F.size("__spans") > 0, decontaminate.without_spans(F.col("text"), F.col("__spans"))).otherwise(F.col("text"))
    return restored(marked.withColumn("cut", text), docs, "cut")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    forest, known = secrets.train(docs)
    masked = secrets.redacted(narrowed(docs).withColumn("before", F.col("text")), forest, known)
    return restored(masked, docs, "text", "before")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: The stages hash, learn and tokenise; tests hold them against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
        if before is not None:
            drop_written(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
