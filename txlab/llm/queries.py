"""The operators as named queries over the given tables, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlab.llm.common import read, ship
from txlab.llm.decontamination import decontaminate
from txlab.llm.katz import katz_scores
from txlab.llm.language import languages
from txlab.llm.licenses import scan_licenses
from txlab.llm.near_duplicates import near_duplicates
from txlab.llm.negatives import hard_negatives
from txlab.llm.packing import pack
from txlab.llm.pieces import encode_and_decode
from txlab.llm.search import top_k
from txlab.llm.shards import shard
from txlab.llm.spelling import spelling_variants
from txlab.llm.toxicity import toxicity
from txlab.llm.urls import judge

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = shipped
        if sql is not None:
            ORACLE[name] = sql.strip()
        return function

    return register


@query("op1_license_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts, labels = F.col("places.start"), F.col("places.label")
    covered = F.coalesce(F.array_max("spans.covered"), F.lit(0.0))
    return scan_licenses(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.col("spans.label"))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(covered).alias("score"),
    )


@query("op2_url_filter")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


@query("op3_sentencepiece_encode_decode")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_and_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


_WORDS = """list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""

OP5 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
n AS (SELECT item_id, ws, least(len(ws), 10) AS span FROM i WHERE len(ws) > 0),
win AS (
  SELECT DISTINCT item_id, span, unnest(list_transform(range(0, len(ws) - span + 1),
    lambda p: array_to_string(ws[p + 1:p + span], ' '))) AS passage FROM n),
spans AS (SELECT DISTINCT span FROM win),
runs AS (SELECT doc_id, span, ws, unnest(range(0, len(ws) - span + 1)) AS p FROM d JOIN spans ON len(ws) >= span),
hit AS (
  SELECT doc_id, item_id, p, win.span FROM (
    SELECT doc_id, span, p, array_to_string(ws[p + 1:p + span], ' ') AS passage FROM runs) r
  JOIN win ON r.span = win.span AND r.passage = win.passage),
covered AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + span)) AS w FROM hit) GROUP BY 1),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op5_benchmark_decontamination", OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(read(spark, sf_dir, "documents"), read(spark, sf_dir, "pages"))


#: The byte table of CRC-32.
_CRC = """step AS (
  SELECT n, n AS c, 0 AS k FROM range(256) t(n)
  UNION ALL
  SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM step WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM step WHERE k = 8)"""

OP7 = f"""
WITH RECURSIVE {_CRC},
b AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes
  FROM documents),
s AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(bytes,
    lambda a, x: xor(a // 256, t[xor(a, x) % 256 + 1]), 4294967295)) AS text_crc32
  FROM b, crc),
p AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id) AS upto, sum(size) OVER () AS total FROM s),
c AS (SELECT *, ((16 * (2 * upto - size)) // (2 * total))::INT AS shard FROM p)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1)::BIGINT AS slot, NULL::INT AS grown_shard FROM c
"""


@query("op7_sharding", OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op8_token_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


OP9 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
  WHERE 100 * k >= 80 * (na.n + nb.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT doc_id, b FROM reach JOIN both_ways ON other = a),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query("op9_minhash_near_dedup", OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), size=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


@query("op10_exact_top_k", OP10)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"))


OP11 = f"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY 1, 2),
marks AS (
  SELECT run, k, xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda a, x: xor(a // 256, t[xor(a, x) % 256 + 1]), 4294967295)) AS h
  FROM runs, crc),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
    ELSE run END AS word, sum(k)::BIGINT AS n
  FROM marks GROUP BY 1 HAVING length(word) >= 7 AND sum(k) >= 2),
holes AS (
  SELECT word, n, unnest(range(length(word))) AS p FROM words),
around AS (
  SELECT word, n, length(word) AS size, p, left(word, p) AS head, substr(word, p + 2) AS tail FROM holes),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM around a JOIN around b USING (size, p, head, tail) WHERE a.word <> b.word
  UNION SELECT a.word, w.word, w.n FROM around a JOIN words w ON w.word = a.head || a.tail
  UNION SELECT w.word, a.word, a.n FROM around a JOIN words w ON w.word = a.head || a.tail),
best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(less := -near_n, form := near)) AS b FROM pairs GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 10 * n THEN b.form END AS form,
    CASE WHEN -b.less >= 10 * n THEN -b.less END AS form_n
  FROM words LEFT JOIN best USING (word)),
reach AS (
  SELECT word, word AS root, 0 AS depth FROM forms
  UNION ALL
  SELECT reach.word, forms.form, depth + 1 FROM reach JOIN forms ON root = forms.word WHERE forms.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, depth) AS root FROM reach GROUP BY word)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM forms JOIN roots USING (word)
"""


@query("op11_spelling_variants", OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"))


@query("op12_katz_scores")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 1, F.lit(True))
    return katz_scores(read(spark, sf_dir, "documents"), learn)


OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id, list_inner_product(a.e, v.e)::BIGINT AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op13_hard_negatives", OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", moved))
