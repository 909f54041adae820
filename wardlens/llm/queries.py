"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlens.llm import (
    bwt, embeddings, manifest, mixing, packing, pages, ppm, quality, sharding, simhash, spans, variants, warc,
)
from wardlens.llm.common import ship_code
from wardlens.sources.staging import staging_path
from wardlens.sources.tables import load


def op1_partial_matching(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return ppm.score_texts(docs, held, ppm.file_chunks())


def op2_golden_schedule(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.taken(*mixing.mix(load(spark, folder, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots")


OP2_SQL = """
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(text) || ':' || text, '-')) AS key
  FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
               ORDER BY 3 * source_size / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sums
), wanted AS (
  SELECT source, source_size, least(3.0 * source_size, max(level) OVER () * weight)::DOUBLE AS target
  FROM levels
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY key) AS rank,
         (sum(size) OVER (PARTITION BY source ORDER BY key ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized
), shares AS (
  SELECT *, floor(target + 0.5)::BIGINT AS words, ceil(floor(target + 0.5) / 1024)::BIGINT AS blocks FROM wanted
), laid AS (
  SELECT *, sum(blocks) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING)::BIGINT AS above FROM shares
), total AS (
  SELECT n, greatest(1, round(n * 0.6180339887498949))::BIGINT AS golden
  FROM (SELECT sum(blocks)::BIGINT AS n FROM shares)
), stepped AS (
  SELECT n, list_filter(range(golden, golden + 1000), lambda s: gcd(s, n) = 1)[1] AS step FROM total WHERE n > 0
), points AS (
  SELECT slot, ((slot::HUGEINT * step) % n)::BIGINT AS point
  FROM (SELECT unnest(range(n)) AS slot, n, step FROM stepped)
), slots AS (
  SELECT slot, source, row_number() OVER (PARTITION BY above ORDER BY slot) - 1 AS block
  FROM points JOIN laid ON point >= above - blocks AND point < above
), reads AS (
  SELECT placed.source, rank, pass * source_size + start AS lo,
         least(pass * source_size + start + size, words) AS hi
  FROM placed JOIN shares ON placed.source IS NOT DISTINCT FROM shares.source,
       (SELECT unnest([0, 1, 2]) AS pass)
  WHERE size > 0 AND pass * source_size + start < words
), used AS (
  SELECT reads.source, rank, min(slot) AS first_slot, count(DISTINCT slot) AS n_slots,
         sum(least(hi, (block + 1) * 1024) - greatest(lo, block * 1024)) AS taken
  FROM reads JOIN slots
    ON reads.source IS NOT DISTINCT FROM slots.source AND block BETWEEN lo // 1024 AND (hi - 1) // 1024
  GROUP BY reads.source, rank
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_slot,
       coalesce(n_slots, 0) AS n_slots
FROM placed JOIN wanted ON placed.source IS NOT DISTINCT FROM wanted.source
LEFT JOIN used ON placed.source IS NOT DISTINCT FROM used.source AND placed.rank = used.rank
"""


def op3_label_propagation(spark: SparkSession, folder: str) -> DataFrame:
    shards = sharding.shard_documents(load(spark, folder, "documents"), shards=24)
    return shards.withColumn("grown_shard", F.lit(None).cast("int"))


def op4_segment_reassembly(spark: SparkSession, folder: str) -> DataFrame:
    archives = staging_path(spark, "archives")
    warc.write_archives(load(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP4_SQL = """
WITH marked AS (
  SELECT page_id, coalesce(html, '') AS payload,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
), revisits AS (
  SELECT *, CASE WHEN strlen(payload) >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first
            THEN first END AS refers_to
  FROM marked
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM revisits
"""


def op5_sentence_runs(spark: SparkSession, folder: str) -> DataFrame:
    return spans.remove_repeats(load(spark, folder, "documents")).select(
        "doc_id", F.size("removed_sentences").cast("long").alias("n_removed"), "removed_sentences", "text"
    )


def op6_trie_join(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, folder, "documents"), simhash.FOUR_BITS)


def op7_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return quality.measure(load(spark, folder, "documents"))


def op8_histogram_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.cut_documents(
        load(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests)


def op9_page_differencing(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(load(spark, folder, "pages"))


def op10_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.linked_vectors(load(spark, folder, "embeddings"), threshold=0.93)


def op11_merged_transforms(spark: SparkSession, folder: str) -> DataFrame:
    found = bwt.repeated_bytes(load(spark, folder, "documents"))
    cut = bwt.without_ranges(found.select("doc_id", "text", "repeated"))
    removed = F.aggregate("repeated", F.lit(0).cast("long"), lambda n, r: n + (r["ends"] - r["begins"]))
    return cut.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size("repeated").cast("long").alias("n_spans"), "kept_sha256",
    )


def op12_dense_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return variants.group_variants(variants.word_counts(load(spark, folder, "documents")))


def op13_interval_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    proofs = manifest.document_proofs(docs, changed=more, changed_where=picked)
    root = manifest.folded(F.col("claimed"), F.col("proof"))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root",
        manifest.siblings_digest(F.col("proof")).alias("proof_sha256"), root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_code(spark)
        return query(spark, folder)

    return run


OP10_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93
), reached(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id)::BIGINT AS n_links,
       least(e.vec_id, coalesce((SELECT min(b) FROM reached r WHERE r.a = e.vec_id), e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce((SELECT min(b) FROM reached r WHERE r.a = e.vec_id), e.vec_id)) AS kept
FROM embeddings e
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: _shipped(fn)
    for fn in (
        op1_partial_matching,
        op2_golden_schedule,
        op3_label_propagation,
        op4_segment_reassembly,
        op5_sentence_runs,
        op6_trie_join,
        op7_compression_bands,
        op8_histogram_packing,
        op9_page_differencing,
        op10_multi_index,
        op11_merged_transforms,
        op12_dense_tiles,
        op13_interval_manifest,
    )
}

CHECKS: dict[str, str] = {
    "op2_golden_schedule": OP2_SQL,
    "op4_segment_reassembly": OP4_SQL,
    "op10_multi_index": OP10_SQL,
}
