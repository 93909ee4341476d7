"""Named queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cograph.llm import blockmax, compression_quality, maxscore, merge_replay, merkle, packing, preference, simhash, stream_dedup, substring_dedup, suffix_dedup, warc, winnowing
from cograph.session import scratch_folder

#: A document is kept when its quality score reaches this.
QUALITY_CUT = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passage_classes(_table(spark, sf_dir, "documents"))


def op3_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = maxscore.integer_vectors(_table(spark, sf_dir, "embeddings"))
    return maxscore.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.edited_fingerprints(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex("hashes")).alias("fingerprint"),
                        F.lower(F.hex("edited_hashes")).alias("edited_fingerprint"), "near_edited", "near_next")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), suffix_dedup.Repeats(length=200))


def op6_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = compression_quality.fit_quality(docs, _table(spark, sf_dir, "labels"))
    return compression_quality.score_quality(docs, model).select(
        "doc_id", compression_quality.held_out().alias("held_out"), "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


def op7_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return merge_replay.digests(merge_replay.encode(_table(spark, sf_dir, "documents"), ranks, round_trip=True))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    manifest = warc.write_archive(_table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(manifest, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.format_pairs(*preference.mismatched_replies(_table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s[0], s[1])), ",").alias(c)
    return pairs.select("pair_id", F.col("prompt_turns").cast("long").alias("prompt_turns"), "prompt", "chosen", "rejected",
                        spans("chosen_mask"), spans("rejected_mask"), F.col("n_chosen").cast("long").alias("n_chosen"), F.col("n_rejected").cast("long").alias("n_rejected"), "informative")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words_per_shingle=4, bits=4).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.exact_duplicates(spark, stream_dedup.Source(f"{sf_dir}/documents.parquet"), scratch_folder(spark, "dedup-state"))


def op12_block_max_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockmax.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(_table(spark, sf_dir, "documents"))


SPARK = {
    "op1_retrieval_packing": op1_retrieval_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_maxscore": op3_maxscore,
    "op4_winnowing": op4_winnowing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_compression_quality": op6_compression_quality,
    "op7_merge_replay": op7_merge_replay,
    "op8_warc": op8_warc,
    "op9_preference": op9_preference,
    "op10_simhash": op10_simhash,
    "op11_stream_dedup": op11_stream_dedup,
    "op12_block_max_maxscore": op12_block_max_maxscore,
    "op13_merkle_manifest": op13_merkle_manifest,
}

OP3_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)]), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

OP9_SQL = """
WITH t AS (
  SELECT conv_id AS pair_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) - 1 AS position,
         coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT pair_id, max(position) AS last FROM t WHERE role = 'assistant' GROUP BY pair_id
), a AS (
  SELECT t.pair_id, t.role, t.text FROM t JOIN l ON t.pair_id = l.pair_id AND t.position = l.last
), r AS (
  SELECT t.pair_id, t.position, t.role, t.text FROM t LEFT JOIN l ON t.pair_id = l.pair_id WHERE l.last IS NULL OR t.position < l.last
  UNION ALL
  SELECT l.pair_id, l.last, a.role, a.text FROM l JOIN a ON a.pair_id = xor(l.pair_id, 1)
), b AS (
  SELECT coalesce(t.pair_id, r.pair_id) AS pair_id, coalesce(t.position, r.position) AS position,
         t.role AS crole, t.text AS ctext, r.role AS rrole, r.text AS rtext
  FROM t FULL JOIN r ON t.pair_id = r.pair_id AND t.position = r.position
), s AS (
  SELECT pair_id, max(position) AS last,
         coalesce(min(position) FILTER (WHERE crole IS DISTINCT FROM rrole OR ctext IS DISTINCT FROM rtext), max(position) + 1) AS split
  FROM b GROUP BY pair_id
), d AS (
  SELECT b.pair_id, b.position, s.split, s.last, b.position >= s.split AS after, crole, rrole,
         '<|im_start|>' || crole || chr(10) || ctext || '<|im_end|>' || chr(10) AS cturn,
         '<|im_start|>' || rrole || chr(10) || rtext || '<|im_end|>' || chr(10) AS rturn
  FROM b JOIN s USING (pair_id)
), e AS (
  SELECT *,
         coalesce(sum(CASE WHEN after THEN length(cturn) END) OVER w, 0) - CASE WHEN after THEN coalesce(length(cturn), 0) ELSE 0 END AS cat,
         coalesce(sum(CASE WHEN after THEN length(rturn) END) OVER w, 0) - CASE WHEN after THEN coalesce(length(rturn), 0) ELSE 0 END AS rat
  FROM d WINDOW w AS (PARTITION BY pair_id ORDER BY position ROWS UNBOUNDED PRECEDING)
)
SELECT pair_id, CAST(any_value(split) AS BIGINT) AS prompt_turns,
       coalesce(string_agg(cturn, '' ORDER BY position) FILTER (WHERE NOT after), '') AS prompt,
       coalesce(string_agg(cturn, '' ORDER BY position) FILTER (WHERE after), '') AS chosen,
       coalesce(string_agg(rturn, '' ORDER BY position) FILTER (WHERE after), '') AS rejected,
       coalesce(string_agg(CAST(CAST(cat AS BIGINT) + 13 + length(crole) AS VARCHAR) || '-' || CAST(CAST(cat AS BIGINT) + length(cturn) - 1 AS VARCHAR), ',' ORDER BY position)
                FILTER (WHERE after AND crole = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(CAST(CAST(rat AS BIGINT) + 13 + length(rrole) AS VARCHAR) || '-' || CAST(CAST(rat AS BIGINT) + length(rturn) - 1 AS VARCHAR), ',' ORDER BY position)
                FILTER (WHERE after AND rrole = 'assistant'), '') AS rejected_mask,
       count(cturn) FILTER (WHERE after) AS n_chosen, count(rturn) FILTER (WHERE after) AS n_rejected,
       any_value(split) <= any_value(last) AS informative
FROM e GROUP BY pair_id
"""

def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"


# crc32 of a decimal number: for each character its code and eight steps (marked -1)
_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten([[CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
  FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""

OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, {_field("doc_id")} || {_field("source")} || {_field("lang")} AS head,
         CAST(n_chars AS HUGEINT) AS n_chars, {_field("text")} AS tail,
         doc_id IS NOT NULL AND {_CRC32} % 7 = 0 AS changed
  FROM documents
), l AS (
  SELECT rid, doc_id, lang, sha256(head || {_field("n_chars")} || tail) AS leaf,
         CASE WHEN changed THEN sha256(head || {_field("(n_chars + 1)")} || tail) ELSE sha256(head || {_field("n_chars")} || tail) END AS shown
  FROM d
), p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l
), up(lang, lvl, pos, h, n) AS (
  SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM p
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM up WHERE n > 1 GROUP BY lang, lvl, pos // 2
), s AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM up WHERE n = 1
), top(lvl, pos, h, n) AS (
  SELECT 0, pos, subroot, count(*) OVER () FROM s
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM top WHERE n > 1 GROUP BY lvl, pos // 2
), own AS (
  SELECT p.rid, c.lvl AS step, c.pos & 1 AS side, b.h
  FROM p JOIN up c ON c.lang IS NOT DISTINCT FROM p.lang AND c.n > 1 AND c.pos = p.pos >> c.lvl
  LEFT JOIN up b ON b.lang IS NOT DISTINCT FROM c.lang AND b.lvl = c.lvl AND b.pos = xor(c.pos, 1)
  UNION ALL
  SELECT p.rid, 1000 + c.lvl, c.pos & 1, b.h
  FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang JOIN top c ON c.n > 1 AND c.pos = s.pos >> c.lvl
  LEFT JOIN top b ON b.lvl = c.lvl AND b.pos = xor(c.pos, 1)
), path AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY step) AS k FROM own
), fold(rid, k, h) AS (
  SELECT rid, CAST(0 AS BIGINT), shown FROM p
  UNION ALL
  SELECT f.rid, x.k, sha256(CASE WHEN x.h IS NULL THEN f.h WHEN x.side = 1 THEN x.h || f.h ELSE f.h || x.h END)
  FROM fold f JOIN path x ON x.rid = f.rid AND x.k = f.k + 1
), folded AS (
  SELECT rid, arg_max(h, k) AS folded_root FROM fold GROUP BY rid
), proofs AS (
  SELECT rid, sha256(coalesce(string_agg(h, '' ORDER BY k), '')) AS proof_sha256 FROM path GROUP BY rid
)
SELECT p.doc_id, p.leaf, s.subroot, r.h AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
       f.folded_root, f.folded_root = r.h AS verified
FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang JOIN top r ON r.n = 1
JOIN folded f ON f.rid = p.rid LEFT JOIN proofs q ON q.rid = p.rid
"""

_TERMS = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"

OP12_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, text FROM documents
), t AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, {_TERMS} AS term FROM d) GROUP BY rid, term
), l AS (
  SELECT rid, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY rid
), s AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM l
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * s.docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term, s.docs
), q AS (
  SELECT item_id, term, count(*) AS c FROM (SELECT item_id, {_TERMS} AS term FROM benchmark) GROUP BY item_id, term
), x AS (
  SELECT q.item_id, t.rid, CAST(sum(q.c * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * l.n * s.docs) // s.total)))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN l USING (rid), s GROUP BY q.item_id, t.rid
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM x JOIN d USING (rid) WHERE score > 0 QUALIFY rank <= 20
"""

OP11_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW w AS (PARTITION BY t)
"""

SQL: dict[str, str] = {
    "op11_stream_dedup": OP11_SQL,
    "op12_block_max_maxscore": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
    "op3_maxscore": OP3_SQL,
    "op9_preference": OP9_SQL,
}
