"""The registered queries of this subpackage: thin wrappers that derive the contract's columns from the operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdwise.llm.common import table
from holdwise.llm.encoding import encode
from holdwise.llm.exactdup import exact_duplicates
from holdwise.llm.language import languages
from holdwise.llm.mixing import mixed
from holdwise.llm.neardup import near_duplicates
from holdwise.llm.negatives import hard_negatives
from holdwise.llm.neighbours import nearest
from holdwise.llm.packing import pack
from holdwise.llm.pii import joined, personal_data
from holdwise.llm.quality import quality
from holdwise.llm.sharding import shards
from holdwise.llm.toxicity import toxicity
from holdwise.llm.trie import prefix_trie

VOCAB = "byte_bpe_50k.json"


def vocab_path() -> str:
    return public_tokenizers.path(VOCAB)


def packed(docs: DataFrame) -> DataFrame:
    pieces = pack(docs, vocab_path(), size=1024, end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shards(table(spark, sf_dir, "documents"), count=16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{kind}'))").cast("long").alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, top=5)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode(table(spark, sf_dir, "documents"), vocab_path(), decoded=True)
    return rows.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).drop("source")


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, F.col("id") % 7 == 0)


#: Group sizes and winners by the text itself; hashing and joining are DuckDB's.
EXACT_DEDUP_SQL = """
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(coalesce(d.text, '')) AS text_sha256
FROM documents d
JOIN (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size FROM documents GROUP BY 1) g
  ON g.t = coalesce(d.text, '')
"""

#: CRC-32 by bits (reflected polynomial); nodes by lists of turns; totals by pairs of a node and its descendants.
TRIE_SQL = r"""
WITH crc AS (
  SELECT conv_id AS c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
),
built AS (
  SELECT crc.c, 0 AS part, i, r, t FROM crc JOIN turns ON turns.c = crc.c - crc.c % 20 AND i <= h
  UNION ALL SELECT crc.c, 1, i, r, t FROM crc JOIN turns ON turns.c = crc.c AND i > h
),
paths AS (
  SELECT c, row_number() OVER w AS depth, list({'r': r, 't': t}) OVER w AS seq, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words
  FROM built WINDOW w AS (PARTITION BY c ORDER BY part, i ROWS UNBOUNDED PRECEDING)
),
members AS (
  SELECT c, depth, seq, words FROM paths
  UNION ALL SELECT c, 0, [], 0 FROM crc
),
named AS (SELECT seq, min(c) AS node, count(*) AS n, max(words) AS words FROM members GROUP BY seq),
mem AS (SELECT m.c, m.depth, k.node FROM members m JOIN named k ON m.seq = k.seq),
nodes AS (SELECT len(k.seq) AS depth, k.node, k.n, k.words, p.node AS parent FROM named k LEFT JOIN mem p ON p.c = k.node AND p.depth = len(k.seq) - 1),
kids AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY ALL),
own AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (node, depth)),
below AS (SELECT DISTINCT a.node, a.depth, b.node AS dn, b.depth AS dd FROM mem a JOIN mem b ON a.c = b.c AND b.depth >= a.depth),
totals AS (
  SELECT b.node, b.depth, count(*) FILTER (WHERE o.n_children = 0) AS n_leaves, sum((o.n - 1) * o.words) AS saved
  FROM below b JOIN own o ON o.node = b.dn AND o.depth = b.dd GROUP BY ALL
),
ends AS (
  SELECT m.node, m.depth, string_agg(m.c::VARCHAR, ',' ORDER BY m.c) AS ids
  FROM mem m JOIN (SELECT c, max(depth) AS depth FROM mem GROUP BY c) l USING (c, depth) GROUP BY ALL
)
SELECT o.node::BIGINT AS conv_id, o.depth::BIGINT AS depth, o.parent::BIGINT AS parent_conv_id, o.n::BIGINT AS n_convs, o.n_children::BIGINT AS n_children,
       t.n_leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM own o JOIN totals t USING (node, depth) LEFT JOIN ends e USING (node, depth)
"""

#: All scores of an anchor, ranked by windows.
NEGATIVES_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.id AS a, b.id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 50 = 0
),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS k FROM s WHERE same) WHERE k <= 5),
n AS (
  SELECT p.a, p.b AS p, s.b AS n, p.score AS ps, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS k
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT a AS anchor_id, p AS positive_id, k::INTEGER AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE k <= 3
"""

QUERIES = {
    "op1_packing": op1_packing,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_language": op4_language,
    "op5_minhash": op5_minhash,
    "op6_sharding": op6_sharding,
    "op7_pii": op7_pii,
    "op8_neighbours": op8_neighbours,
    "op9_quality": op9_quality,
    "op10_bpe": op10_bpe,
    "op11_trie": op11_trie,
    "op12_mixing": op12_mixing,
    "op13_negatives": op13_negatives,
}
SQL = {"op2_exact_dedup": EXACT_DEDUP_SQL, "op11_trie": TRIE_SQL, "op13_negatives": NEGATIVES_SQL}
