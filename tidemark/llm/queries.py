"""One query for each operator of the subpackage, over whole tables; SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tidemark.llm import bpe, chunks, collisions, debruijn, html_text, jaccard, licenses, mixing, negatives, quality, sharding, tries, warc
from tidemark.llm.common import bounded_batches, table, tokenizer_path
from tidemark.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bounded_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return register


@query("op1_license_rules", licenses.scan_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.size("sentence_ids").cast("long").alias("n_sentences"))


@query("op2_chunk_recipes", """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY t)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    found = chunks.exact_duplicates(docs, carry=("text_sha256",))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op3_source_mix")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_neighbour_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~quality.held_out(F.col("doc_id")))
    return quality.scored(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.ACCEPTED).cast("int").alias("predicted"),
    )


@query("op5_host_paths")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op6_kd_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op8_warc_round_trip", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    g AS (SELECT *, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS top FROM p)
    SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
           CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
    FROM g""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    found = warc.read_warc(spark, path, payload=False)
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    return found.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        F.when(F.col("error").isNull(), F.col("record_type")).otherwise(F.raise_error(F.col("error"))).alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


@query("op9_word_table_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), decoded="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query("op7_signature_tree_jaccard")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_collision_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op11_prefix_trie", """
    WITH c AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
               FROM conversations WHERE conv_id IS NOT NULL),
    whole AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY i) AS turns FROM c GROUP BY conv_id),
    crc AS (SELECT *, xor(list_reduce(
                list_prepend(CAST(4294967295 AS BIGINT),
                             list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
                lambda h, b: list_reduce(list_prepend(xor(h, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
                    lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 6 AS h
            FROM whole),
    rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
                FROM crc AS c LEFT JOIN whole AS b ON b.conv_id = c.conv_id - c.conv_id % 100),
    members AS (SELECT conv_id, d, turns[1:d] AS node, d = len(turns) AS ends FROM rebuilt, unnest(range(0, len(turns) + 1)) AS t(d)),
    nodes AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n,
                     string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends) AS ended,
                     CASE WHEN d > 0 THEN (count(*) - 1) * length(node[d].text) ELSE 0 END AS worth
              FROM members GROUP BY node, d),
    marked AS (SELECT *, CASE WHEN d > 0 THEN node[1:d - 1] END AS parent FROM nodes),
    children AS (SELECT parent, count(*) AS k FROM marked WHERE d > 0 GROUP BY parent),
    full_nodes AS (SELECT m.*, coalesce(k, 0) AS k FROM marked AS m LEFT JOIN children AS c ON c.parent = m.node),
    subtrees AS (SELECT node[1:a] AS top, count(*) FILTER (WHERE k = 0) AS leaves, sum(worth) AS saved
                 FROM full_nodes, unnest(range(0, d + 1)) AS t(a) GROUP BY 1)
    SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, m.n AS n_convs, m.k AS n_children,
           leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(m.ended, '')) AS ends_sha256
    FROM full_nodes AS m JOIN subtrees ON top = m.node LEFT JOIN marked AS p ON p.node = m.parent""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op12_subset_sum_negatives", """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
      FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
    positives AS (
      SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, p.vec_id AS positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
           n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives AS p JOIN scored AS n USING (anchor_id)
    WHERE NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score QUALIFY rank <= 5""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = F.col("vec_id")
    vectors = table(spark, sf_dir, "embeddings")
    shifted = vectors.withColumn("label", F.when(vec % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(shifted, vec % 100 == 0)


@query("op13_repeated_passages", """
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    windows AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k FROM d, unnest(range(1, len(w) - 18)) AS t(s)),
    ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, s) AS r FROM windows),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE r > 1),
    removed AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
    kept AS (SELECT d.doc_id, len(w) AS n, CASE WHEN ps IS NULL THEN w
                    ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END AS k
             FROM d LEFT JOIN removed ON d.doc_id IS NOT DISTINCT FROM removed.doc_id)
    SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(k) AS BIGINT) AS n_removed,
           sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = debruijn.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
