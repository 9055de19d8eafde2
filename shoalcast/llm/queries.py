"""One query for each operator over its whole table, and the SQL twins of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalcast.llm import chat, decontaminate, exact_dedup, hard_negatives, language, minhash, packing, pages, quality, secrets, spelling, suffix_dedup, toxicity
from shoalcast.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(fold("doc_id", 5) != 0))
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return language.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "similarity", "rejected")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.findings(docs, *secrets.train(docs))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chat(table(spark, sf_dir, "conversations"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return marked.select(
        "doc_id",
        F.col("__words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (F.size("__spans") > 0).alias("contaminated"),
    )


def toxicity_model(spark: SparkSession, sf_dir: str):
    """Fitted on the rows outside the held-out fold."""
    return toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir))
    return scored.select(
        "doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


def op9_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages")).drop("n_lines", "n_shared")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 50 == 0)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES: dict[str, str] = {
    "op6_decontamination": rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM benchmark),
phrases AS (SELECT DISTINCT item_id, list_aggregate(w[i:i + 9], 'string_agg', ' ') AS phrase, least(len(w), 10) AS n
    FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM phrases),
places AS (SELECT k, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS phrase
    FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT p.k, p.i, p.n, item_id FROM places p JOIN phrases USING (phrase, n)),
hits AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT k, i, n FROM found)) GROUP BY k),
items AS (SELECT k, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS listed
    FROM (SELECT DISTINCT k, item_id::VARCHAR AS x FROM found) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (k) LEFT JOIN items USING (k)
""",
    "op11_exact_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER first AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER first = 1 AS kept, text_sha256
FROM d WINDOW first AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST, k)
""",
    "op12_hard_negatives": """
WITH v AS (SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (SELECT a.k, a.vec_id AS anchor_id, b.k AS other, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v a, v b WHERE a.vec_id % 50 = 0),
positives AS (SELECT * FROM scores WHERE same AND k <> other
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id NULLS LAST, other) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    (row_number() OVER (PARTITION BY p.k, p.other ORDER BY n.score DESC, n.vec_id NULLS LAST, n.other))::INTEGER AS rank
FROM positives p JOIN scores n ON n.k = p.k AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
""",
    "op13_spelling": """
WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
        lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT doc_id, run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id || ':' || run, ''),
        lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT] ELSE [195, unicode(s)::BIGINT - 64] END))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM runs, crc),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 199 = 0
        THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS MATERIALIZED (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
shorter AS (SELECT cut.word, rest FROM cut JOIN words w ON w.word = cut.rest),
near AS (SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT word, rest FROM shorter UNION SELECT rest, word FROM shorter),
best AS (SELECT near.word, count(*) AS n_near, max(w.n) AS best_n,
        min(CASE WHEN w.n = m THEN w.word END) AS form
    FROM (SELECT *, max(n) OVER (PARTITION BY word) AS m FROM (SELECT near.*, w.n FROM near JOIN words w ON w.word = near.other)) near
    JOIN words w ON w.word = near.other GROUP BY near.word),
formed AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN form END AS form,
        CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM words LEFT JOIN best USING (word)),
path AS (SELECT word, word AS root, form AS next FROM formed
    UNION ALL SELECT path.word, f.word, f.form FROM path JOIN formed f ON f.word = path.next)
SELECT formed.word, n, n_near, form, form_n, root FROM formed JOIN path ON path.word = formed.word AND path.next IS NULL
""",
}

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_language,
        op3_quality,
        op4_secrets,
        op5_chat,
        op6_decontamination,
        op7_toxicity,
        op8_suffix_dedup,
        op9_pages,
        op10_minhash,
        op11_exact_dedup,
        op12_hard_negatives,
        op13_spelling,
    )
}
