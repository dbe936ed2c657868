"""Registered queries of the operators. Each derives the columns of its contract from its operator's results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesora.llm import (
    bitplane,
    boosted_rules,
    decontaminate,
    line_dedup,
    mixing,
    near_dup,
    phrases,
    quality,
    sharding,
    substrings,
    token_counts,
    topk,
    turn_repair,
)
from tesora.llm.common import n_words_of, stored, text_of


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written in byte planes and read back."""
    read = bitplane.round_trip(table(spark, sf_dir, "documents"), vocabulary())
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_simhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat an earlier line, exactly or nearly."""
    found = line_dedup.removed_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their source's target and the words that the mix takes of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words_of().alias("n_words"))
    placed, sources = mixing.place(docs, F.col("n_words"))
    placed = stored(placed.select("doc_id", "source_index", "size", "begin"), "mix")
    got = mixing.with_targets(mixing.taken(placed, mixing.mix(placed, sources)), sources)
    return got.select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary())


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that share a passage."""
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row_key")


def op7_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op8_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts differ by one at most."""
    docs = table(spark, sf_dir, "documents")
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text_of()) + 8).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
    placed = sharding.assign(narrow, 24, key=("doc_id", "text_crc32"), spread=("size",))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digests(table(spark, sf_dir, "documents"))


def op10_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best of all embeddings for every fiftieth."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op11_boosted_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of the boosted trees for every document."""
    return boosted_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("score")


def op12_toivonen_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 collocations of two or three words."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule and repaired."""
    return turn_repair.digests(turn_repair.repair(turn_repair.damage(table(spark, sf_dir, "conversations"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op")}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return {"op7_minhash_components": COMPONENTS, "op9_fm_index": REPEATS, "op10_norm_buckets": NEAREST, "op12_toivonen_phrases": PHRASES, "op13_turn_repair": REPAIRED}


NEAREST = """
WITH sound AS (
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM sound q JOIN sound c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY rank <= 5
"""

PHRASES = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, size, list_slice(w, i, i + size - 1) AS g, count(*) AS f
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM split, (VALUES (1), (2), (3)) AS sizes(size) WHERE len(w) >= size)
    GROUP BY ALL
), total AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT * FROM grams WHERE size > 1 AND f >= 10
), cut AS (
    SELECT c.lang, c.g, c.size, c.f AS a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN grams x ON x.lang = c.lang AND x.g = c.g[1:k]
    JOIN grams y ON y.lang = c.lang AND y.g = c.g[k + 1:c.size]
), best AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), inside AS (
    SELECT lang, g[i:i + 1] AS g, max(f) AS longer
    FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE size = 3)
    GROUP BY 1, 2
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.g, ' ')) AS rank,
       array_to_string(b.g, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best b JOIN total t ON t.lang = b.lang LEFT JOIN inside i ON i.lang = b.lang AND i.g = b.g
WHERE i.longer IS NULL OR 100 * i.longer < 50 * a
QUALIFY rank <= 2000
"""

REPAIRED = """
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce(
        list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
), named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
               lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8))) % 20 AS how
    FROM conversations, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
           CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE how WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM named WHERE how <> 0
), numbered AS (
    SELECT *, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS bare,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i
    FROM damaged
), judged AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
           CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
    FROM numbered
), inserts (a, n, b, audit, lines) AS (
    VALUES (0, 0, 0, '', ''), (0, 1, 2, 'I', E'\nuser:'), (0, 2, 3, 'II', E'\nuser:\nassistant:'),
           (1, 0, 1, '', ''), (1, 1, 2, 'I', E'\nuser:'), (1, 2, 3, 'II', E'\nuser:\nassistant:'),
           (2, 0, 2, '', ''), (2, 1, 3, 'I', E'\nassistant:'), (2, 2, 2, 'II', E'\nassistant:\nuser:'),
           (3, 0, 3, '', ''), (3, 1, 2, 'I', E'\nuser:'), (3, 2, 3, 'II', E'\nuser:\nassistant:')
), edits (e, price, b, initial, c) AS (
    VALUES ('D', 2, 0, NULL, 0), ('D', 2, 1, NULL, 1), ('D', 2, 2, NULL, 2), ('D', 2, 3, NULL, 3),
           ('R', 1, 0, NULL, 2), ('R', 1, 1, NULL, 2), ('R', 1, 2, NULL, 3), ('R', 1, 3, NULL, 2),
           ('K', 0, 0, 's', 1), ('K', 0, 0, 'u', 2), ('K', 0, 1, 'u', 2), ('K', 0, 2, 'a', 3), ('K', 0, 3, 'u', 2)
), fold AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM conversations
    UNION ALL
    (SELECT conv_id, i, state, cost, audit, lines FROM (
        SELECT j.conv_id, j.i, e.c AS state,
               f.cost + 5 * s.n + e.price + CASE WHEN e.e <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost,
               f.audit || s.audit || e.e AS audit,
               f.lines || s.lines || CASE e.e WHEN 'D' THEN '' WHEN 'K' THEN E'\n' || role || ':' || text
                   ELSE CASE e.c WHEN 3 THEN E'\nassistant:' ELSE E'\nuser:' END || text END AS lines
        FROM fold f
        JOIN judged j ON j.conv_id IS NOT DISTINCT FROM f.conv_id AND j.i = f.i + 1
        JOIN inserts s ON s.a = f.state
        JOIN edits e ON e.b = s.b AND (e.e = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (e.e <> 'K' OR e.initial = left(role, 1))
    ) QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1)
), counts AS (
    SELECT conv_id, count(*) AS n_rows, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
), ended AS (
    SELECT f.conv_id, f.cost + 5 * s.n AS cost, f.audit || s.audit AS audit, f.lines || s.lines AS lines, c.* EXCLUDE (conv_id, n_rows)
    FROM fold f LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM f.conv_id JOIN inserts s ON s.a = f.state AND s.b IN (0, 3)
    WHERE f.i = coalesce(c.n_rows, 0)
    QUALIFY row_number() OVER (PARTITION BY f.conv_id ORDER BY f.cost + 5 * s.n, f.audit || s.audit) = 1
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(substr(lines, 2)) AS repaired_sha256
FROM ended
"""

COMPONENTS = """
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS g FROM split
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
    SELECT x, y FROM shared s JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * s.n >= 80 * (a.n + b.n - s.n)
), both_ways AS (
    SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, b.y FROM reached r JOIN both_ways b ON b.x = r.other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

REPEATS = """
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM split)
), begun AS (
    SELECT g, min(doc_id) AS first_id FROM windows GROUP BY g
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN begun USING (g) WHERE first_id < doc_id
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS line
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split) p
    WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.doc_id = p.doc_id AND c.i = p.i)
    GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""
