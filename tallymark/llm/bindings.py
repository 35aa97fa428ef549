"""The operators applied to whole tables: one query each, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import (
    classifier, embedding_dedup, hard_negatives, jaccard_join, line_dedup, lm_scoring, mixing, order_minhash, periodic_runs,
    quality_rules, sentencepiece, substring_dedup, warc,
)
from tallymark.plans.lineage import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _remainder(n: int):
    """crc32 of the id as text, modulo n; null stays null."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a model of those that are not held out."""
    docs = _table(spark, folder, "documents")
    model = lm_scoring.train(docs.where(_remainder(7) != 2))
    held = F.coalesce(_remainder(7) == 2, F.lit(False))
    return lm_scoring.score(docs, model).withColumn("held_out", held)


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.judge(_table(spark, folder, "documents"))


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score of every document, learned from the rows that are not held out."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").where(_remainder(3) != 1)
    scored = classifier.score(docs, classifier.train(docs, labels))
    held = F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", "predicted")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Write the archive of all pages, read it back, say what its records hold."""
    place = scratch_path(spark, "archive")
    warc.write_archive(_table(spark, folder, "pages"), place)
    return warc.describe(warc.read_archive(spark, place)).drop("record_bytes")


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without their sources' boilerplate lines."""
    out = line_dedup.drop_boilerplate(_table(spark, folder, "documents"))
    return out.select("doc_id", "source", "n_lines", "n_dropped", "text")


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words the mix takes of each document."""
    out = mixing.mix_copies(_table(spark, folder, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the bytes of repeated 200-byte strings."""
    out = substring_dedup.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"), without=["text"])
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text again."""
    return sentencepiece.encode(_table(spark, folder, "documents").select("doc_id", "text")).drop("text")


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents by similarity of their shingles."""
    return jaccard_join.jaccard_components(_table(spark, folder, "documents"))


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings."""
    return embedding_dedup.near_duplicates(_table(spark, folder, "embeddings"))


def op11_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return order_minhash.fingerprint_edits(_table(spark, folder, "documents").select("doc_id", "text"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding among all of them; every seventh has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


def _looped(docs: DataFrame) -> DataFrame:
    """Documents whose crc32 ends in 0 get a text that repeats from some word on; others stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    rows = docs.where(chosen).select(
        "doc_id", F.floor(h / 10).alias("g"), F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "").alias("words")
    )
    n = F.size("words").cast("long")
    rows = rows.withColumn("a", F.col("g") % F.greatest(n, F.lit(1)))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))

    def word(w, i):
        return F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))

    looped = rows.select("doc_id", F.array_join(F.transform("words", word), " ").alias("text"))
    return docs.where(~chosen).select("doc_id", "text").unionByName(looped)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Number of runs, the longest run, and digests of all runs and of the collapsed text, of every document."""
    found = periodic_runs.detect_runs(_looped(_table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("b", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("b.s")).alias("start"), F.col("b.length").alias("length"),
        (-F.col("b.p")).alias("period"), F.expr("1000 * b.length div -b.p").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES |= {"op5_substring_dedup": op5_substring_dedup}
QUERIES |= {"op12_hard_negatives": op12_hard_negatives, "op13_periodic_runs": op13_periodic_runs}
QUERIES |= {"op11_order_minhash": op11_order_minhash}
QUERIES |= {"op9_jaccard_join": op9_jaccard_join}
QUERIES |= {"op7_sentencepiece": op7_sentencepiece, "op10_embedding_dedup": op10_embedding_dedup}
QUERIES |= {"op1_lm_scoring": op1_lm_scoring}
QUERIES |= {"op2_quality_rules": op2_quality_rules, "op4_quality_classifier": op4_quality_classifier}
QUERIES |= {"op3_warc": op3_warc, "op6_line_dedup": op6_line_dedup, "op8_mixing": op8_mixing}

ORACLES["op3_warc"] = """
WITH p AS (
    SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
           sha1(coalesce(html, '')) AS hex, strlen(coalesce(html, '')) AS n
    FROM pages
), five AS (
    SELECT *, [('0x' || substr(hex, 1 + 10 * k, 10))::BIGINT FOR k IN range(4)] AS forties,
           min(page_id) OVER (PARTITION BY html) AS first_id
    FROM p
), named AS (
    SELECT *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((forties[1 + i // 8] >> (35 - 5 * (i % 8))) & 31)::INT, 1) FOR i IN range(32)], '') AS name,
           CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS other
    FROM five
)
SELECT page_id, n AS payload_bytes, name AS payload_digest,
       CASE WHEN other IS NULL THEN 'response' ELSE 'revisit' END AS record_type, other AS refers_to
FROM named
"""
ORACLES["op6_line_dedup"] = rf"""
WITH split AS (
    SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), one AS (
    SELECT DISTINCT r, source, unnest(lines) AS line FROM split
), counted AS (
    SELECT source, line, count(*) AS n FROM one WHERE trim(line) <> '' GROUP BY ALL
), totals AS (
    SELECT source, count(*) AS n_all FROM documents GROUP BY ALL
), bad AS (
    SELECT c.source, list(c.line) AS bad
    FROM counted c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
    WHERE n >= {line_dedup.MIN_PAGES} AND n > n_all * {line_dedup.MAX_RATIO}::DOUBLE GROUP BY c.source
), kept AS (
    SELECT s.*, list_filter(lines, lambda x: NOT list_contains(coalesce(bad, []), x)) AS kept
    FROM split s LEFT JOIN bad b ON s.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source, coalesce(len(lines), 0)::BIGINT AS n_lines,
       coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped,
       CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text
FROM kept
"""
ORACLES["op12_hard_negatives"] = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [CAST(floor(256 * x::DOUBLE) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
           CAST(list_sum([a.v[i] * r.v[i] FOR i IN range(1, len(a.v) + 1)]) AS BIGINT) AS score
    FROM e a JOIN e r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v)
    WHERE a.vec_id % 50 = 0
), p AS (
    SELECT anchor_id, vec_id, score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank
FROM p JOIN s ON p.anchor_id = s.anchor_id
WHERE NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""
