"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import (
    byte_bpe,
    collocations,
    dac,
    decontaminate,
    jaccard_join,
    licences,
    pii_crf,
    prefix_trie,
    quality,
    sharding,
    substring_dedup,
    toxicity,
    url_filter,
)
from pageloom.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written in order of doc_id and read back: doc_id, start, n_tokens, ids_crc32."""
    folder = work_path(spark, "token-files")
    dac.write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_TOKENIZER), END_ID)
    return dac.read_token_files(spark, folder).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item held by a document: doc_id, item_id, n_shingles, n_found, containment."""
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: doc_id, class_id, n_links, n_text_links, n_copies, class_node (hex)."""
    return jaccard_join.similarity_classes(table(spark, sf_dir, "documents")).drop("node").withColumn("class_node", F.hex("class_node"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated 35-word windows removed from all documents: doc_id, n_words, n_removed, kept_sha256."""
    return substring_dedup.repeat_digests(table(spark, sf_dir, "documents"))


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page urls: page_id, host, path, rule, verdict, logit."""
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.fit(url_filter.labelled(spark)))


@query
def op8_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight contiguous shards of nearly equal bytes."""
    placed = sharding.byte_shards(table(spark, sf_dir, "documents"))
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and log-likelihood ratio of all documents against those labelled as good."""
    docs, trusted = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1")
    return quality.assess(docs, quality.fit(docs, trusted))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents: doc_id, held_out, score, predicted."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    network = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.score(docs, network).withColumn("held_out", toxicity.held_out(F.col("doc_id"))).select("doc_id", "held_out", "score", "predicted")


@query
def op5_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts and digest of the base spans, and all spans."""
    return pii_crf.find_spans(table(spark, sf_dir, "documents"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefixes of all rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


@query
def op12_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence statements of all documents: counts and places of the base phrases, labels and score."""
    return licences.find_licences(table(spark, sf_dir, "documents")).drop("places")


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


# The digest is the usual CRC-32, whose table of 256 entries follows from its polynomial.
CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY n) AS entries FROM (SELECT n, list_reduce(list_concat([n], repeat([0::bigint], 8)),
    lambda c, ignored: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) AS c FROM (SELECT unnest(range(256)) AS n)))"""

ORACLES["op8_byte_shards"] = f"""
WITH {CRC_TABLE},
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: cast('0x' || h as bigint))),
    lambda crc, byte: xor(entries[(xor(crc, byte) & 255) + 1], crc >> 8))) AS text_crc32
  FROM documents, crc_table),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM sized),
sharded AS (SELECT *, least(7, (8 * (2 * before + size)) // (2 * total)) AS shard FROM placed)
SELECT doc_id, cast(size as bigint) AS size, cast(text_crc32 as bigint) AS text_crc32, 'bytes' AS law, cast(shard as int) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32) - 1 AS slot, cast(null as int) AS grown_shard
FROM sharded
"""

# Prefixes are compared as lists of digests; every pair of a node and a prefix of it is made, which small data allow.
ORACLES["op11_conversation_trie"] = f"""
WITH {CRC_TABLE},
said AS (
  SELECT conv_id, turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS d, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(d ORDER BY turn NULLS FIRST, d) AS ds, list(chars ORDER BY turn NULLS FIRST, d) AS cs FROM said GROUP BY conv_id),
headed AS (
  SELECT *, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(cast(conv_id as varchar))), '..'), lambda h: cast('0x' || h as bigint))),
    lambda crc, byte: xor(entries[(xor(crc, byte) & 255) + 1], crc >> 8))) % 6 AS h
  FROM own, crc_table),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.ds, [])[1:c.h], c.ds[c.h + 1:]) AS ds, list_concat(coalesce(b.cs, [])[1:c.h], c.cs[c.h + 1:]) AS cs
  FROM headed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
members AS (SELECT conv_id, ds, cs, unnest(range(0, len(ds) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT depth, array_to_string(ds[1:depth], ',') AS node, any_value(ds[1:depth]) AS path, any_value(if(depth = 0, 0, cs[depth])) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (len(ds) = depth), '')) AS ends_sha256
  FROM members GROUP BY ALL),
children AS (SELECT depth - 1 AS depth, array_to_string(path[1:depth - 1], ',') AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
above AS (
  SELECT up AS depth, array_to_string(path[1:up], ',') AS node, sum((n_convs - 1) * chars) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM (SELECT n.*, c.n_children, unnest(range(0, n.depth + 1)) AS up FROM nodes n LEFT JOIN children c USING (depth, node)) GROUP BY ALL)
SELECT n.conv_id, cast(n.depth as bigint) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, a.n_leaves,
  cast(a.saved_tokens as bigint) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN above a USING (depth, node) LEFT JOIN children c USING (depth, node)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = array_to_string(n.path[1:n.depth - 1], ',')
"""

ORACLES["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) AS piece FROM documents),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
counts AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM lists, (SELECT unnest([1, 2, 3]) AS m)) GROUP BY ALL),
totals AS (SELECT lang, cast(sum(f) as bigint) AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, cast((1000000::hugeint * c.f * c.f) // (l.f::hugeint * r.f) as bigint) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ') JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, f FROM candidates WHERE m = 3),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (FROM held h WHERE h.lang = b.lang AND h.phrase = b.phrase AND 100 * h.f >= 50 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
