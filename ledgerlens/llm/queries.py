"""The corpus operators bound to the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    decontamination,
    hard_negatives,
    html_extraction,
    line_dedup,
    masked_lm,
    packing,
    quality_rules,
    sharding,
    simhash,
    token_counts,
    toxicity,
    url_filters,
    va_clustering,
)

SHARDS = 16
# Site rules: verdict, host, start of the path (fixed values).
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.pseudo_likelihood(read(spark, sf_dir, "documents"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(read(spark, sf_dir, "documents"), shards=SHARDS)
    return out.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(read(spark, sf_dir, "documents"))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.FULL).alias("kept"),
        F.col("failed").alias("failed_rules"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=3)
    return out.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path(), capacity=1024, end_id=2)


def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.col("_lines").cast("long").alias("n_lines"),
        F.size("_removed").cast("long").alias("n_removed"),
        F.md5(F.col("text").cast("binary")).alias("clean_md5"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, rest = token_counts.sentencepiece_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return token_counts.token_counts(read(spark, sf_dir, "documents"), first, rest)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.col("item").alias("item_id"), F.col("n_frames").cast("long").alias("n_frames"), F.col("best").cast("long").alias("best"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filters.judge(read(spark, sf_dir, "pages"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_site_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extraction.extract(read(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", "n_chars", "n_blocks", "n_template")


def op12_va_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = va_clustering.cluster(read(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64, salt="1:")
    return out.drop("compared")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("id") % 100 == 0, scale=256, positives=5, negatives=5, low=80, high=100)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_masked_lm": op1_masked_lm,
        "op2_shards": op2_shards,
        "op3_quality_rules": op3_quality_rules,
        "op4_simhash": op4_simhash,
        "op5_packing": op5_packing,
        "op6_line_windows": op6_line_windows,
        "op7_token_counts": op7_token_counts,
        "op8_decontamination": op8_decontamination,
        "op9_url_filter": op9_url_filter,
        "op10_toxicity": op10_toxicity,
        "op11_site_text": op11_site_text,
        "op12_va_clusters": op12_va_clusters,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    """Where SQL can express the operator; the others are tested against
    brute-force versions."""
    bits = " + ".join(f"CASE WHEN {r} THEN {1 << k} ELSE 0 END" for k, r in enumerate(quality_rules.RULES.values()))
    return {
        "op3_quality_rules": _QUALITY_RULES.replace("FAILED_BITS", bits),
        "op6_line_windows": _LINE_WINDOWS,
        "op8_decontamination": _overlaps(),
        "op12_va_clusters": _va_clusters(),
        "op13_hard_negatives": _HARD_NEGATIVES,
    }


def _overlaps() -> str:
    span, frame, share, run, shortest = (getattr(decontamination, n) for n in ("SPAN", "FRAME", "SHARE", "RUN", "SHORTEST"))
    hashes = [
        f"concat_ws(' ', '{n}', " + ", ".join(f"ws[p + {k + 1}]" for k, c in enumerate(mask) if c == "1") + ")"
        for n, mask in enumerate(decontamination.MASKS)
    ]
    seeds = "[" + ", ".join(hashes) + "]"
    return f"""
WITH texts AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS ws FROM documents
), items AS (
    SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS ws FROM benchmark
), short AS (SELECT item_id, ws, len(ws) AS n FROM items WHERE len(ws) BETWEEN {shortest} AND {span - 1}
), seeds AS (
    SELECT item_id, unnest({seeds}) AS h, greatest(0, least(p - {(frame - span) // 2}, len(ws) - {frame})) AS first, p, ws
    FROM (SELECT *, unnest(range(len(ws) - {span} + 1)) AS p FROM items)
), frames AS (
    SELECT DISTINCT h, item_id, first - p AS off, ws[first + 1 : first + {frame}] AS frame FROM seeds
    UNION SELECT 'whole ' || array_to_string(ws, ' '), item_id, 0, ws FROM short
), places AS (
    SELECT doc_id, p, unnest({seeds}) AS h FROM (SELECT *, unnest(range(len(ws) - {span} + 1)) AS p FROM texts)
    UNION ALL
    SELECT doc_id, p, 'whole ' || array_to_string(ws[p + 1 : p + n], ' ')
    FROM (SELECT doc_id, ws, n, unnest(range(len(ws) - n + 1)) AS p FROM texts, (SELECT DISTINCT n FROM short))
), hits AS (SELECT DISTINCT doc_id, item_id, p + off AS start, frame FROM places JOIN frames USING (h)
), compared AS (
    SELECT doc_id, item_id, len(frame) AS size, array_to_string(list_transform(range(len(frame)),
           lambda k: CASE WHEN start + k >= 0 AND ws[start + k + 1] = frame[k + 1] THEN '1' ELSE '0' END), '') AS same
    FROM hits JOIN texts USING (doc_id)
)
SELECT doc_id, item_id, count(*) AS n_frames, max(length(replace(same, '0', ''))) AS best FROM compared
WHERE 100 * length(replace(same, '0', '')) >= {share} * size OR contains(same, '{"1" * run}')
GROUP BY doc_id, item_id
"""


def _va_clusters(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> str:
    """Every vector against every centroid.  Sums and products are whole numbers that
    DOUBLE holds exactly."""
    parts = [f"""
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS q FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
), c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), q) - 1 AS c, q AS m FROM v
    ORDER BY c LIMIT {k}
)"""]
    for i in range(rounds + 1):
        parts.append(f""", a{i} AS (
    SELECT r, vec_id, q, arg_min(c, {{'d': d, 'c': c}}) AS c, min(d) AS d
    FROM (SELECT r, vec_id, q, c, list_sum(list_transform(list_zip(q, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{i}) GROUP BY r, vec_id, q
)""")
        if i < rounds:
            parts.append(f""", c{i + 1} AS (
    SELECT c{i}.c, coalesce(n.m, c{i}.m) AS m FROM c{i} LEFT JOIN (
        SELECT c, list(s ORDER BY p) AS m FROM (
            SELECT c, p, floor(sum(x) / count(*)) AS s FROM (SELECT c, unnest(q) AS x, generate_subscripts(q, 1) AS p FROM a{i}) GROUP BY c, p
        ) GROUP BY c
    ) n USING (c)
)""")
    parts.append(f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(m, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)
""")
    return "".join(parts)


_HARD_NEGATIVES = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives JOIN scored s USING (anchor_id)
WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5
"""


_LINE_WINDOWS = """
WITH lines AS (
    SELECT doc_id, i, trim(l, ' ') AS l, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
    WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')
), wins AS (
    SELECT a.doc_id, a.pos, md5(a.l || chr(10) || b.l || chr(10) || c.l) AS w
    FROM lines a JOIN lines b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1 JOIN lines c ON c.doc_id = a.doc_id AND c.pos = a.pos + 2
), later AS (
    SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS n FROM wins) WHERE n > 1
), gone AS (
    SELECT DISTINCT l.doc_id, l.i FROM lines l JOIN (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM later) r USING (doc_id, pos)
), pieces AS (
    SELECT d.doc_id, d.i, d.l, g.i IS NOT NULL AS cut
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) d
    LEFT JOIN gone g ON g.doc_id = d.doc_id AND g.i = d.i
), clean AS (
    SELECT doc_id, count(*) FILTER (cut) AS n_removed, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT cut), '') AS t FROM pieces GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed, CASE WHEN d.text IS NULL THEN NULL ELSE md5(c.t) END AS clean_md5
FROM documents d LEFT JOIN clean c USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id) n USING (doc_id)
"""


_QUALITY_RULES = """
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
    FROM documents
), grams AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
    FROM (SELECT doc_id, i, a, lead(a, 1) OVER one AS b, lead(a, 2) OVER one AS c
          FROM (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w) WINDOW one AS (PARTITION BY doc_id ORDER BY i))
    WHERE c IS NOT NULL
), repeated AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE n > 1) GROUP BY doc_id
), measured AS (
    SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^\\p{Lu}]+', '', 'g')) AS n_capitals,
           len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
    FROM w LEFT JOIN repeated r USING (doc_id)
), judged AS (SELECT *, CAST(FAILED_BITS AS BIGINT) AS failed_rules FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failed_rules = 0 AS kept, failed_rules
FROM judged
"""
