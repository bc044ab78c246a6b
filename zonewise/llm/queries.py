"""The registered queries of the subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from zonewise.llm import chat, decontaminate, lexical, lines, pieces, quality, repeats, resample, shards, simhash, topk, warc, windows
from zonewise.plans import Registry

registry = Registry()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registry.add()
def op8_simhash_near_duplicates(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i,
         unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS win
  FROM w WHERE len(ws) >= 13),
least_doc AS (SELECT win, min(doc_id) AS m FROM s GROUP BY win),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM s JOIN least_doc USING (win) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY words.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@registry.add(OP10_SQL)
def op10_substring_dedup(spark, sf_dir):
    found = windows.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@registry.add()
def op9_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.graded(docs, quality.model(docs, table(spark, sf_dir, "labels")))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n,
         unnest(list_transform(range(1, greatest(len(ws) - 12, 1) + 1), lambda i: array_to_string(ws[i:i + 12], ' '))) AS win
  FROM b WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i,
         unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) AS win
  FROM d, sizes WHERE len(ws) >= n),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, win)),
h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@registry.add(OP4_SQL)
def op4_benchmark_decontamination(spark, sf_dir):
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP2_SQL = r"""
WITH l AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
d AS (SELECT DISTINCT doc_id, source, unnest(ls) AS line FROM l),
often AS (
  SELECT d.source, line FROM d JOIN (SELECT source, count(*) AS pages FROM documents GROUP BY source) p
    ON d.source IS NOT DISTINCT FROM p.source
  WHERE trim(translate(line, chr(9) || chr(13) || chr(11) || chr(12), '    ')) <> ''
  GROUP BY d.source, line, pages HAVING count(*) >= 3 AND count(*) > 0.05 * pages),
e AS (SELECT doc_id, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM l),
k AS (
  SELECT e.doc_id, count(*) AS n, string_agg(e.line, chr(10) ORDER BY i) AS t
  FROM e LEFT JOIN often ON e.source IS NOT DISTINCT FROM often.source AND e.line = often.line
  WHERE often.line IS NULL GROUP BY e.doc_id)
SELECT l.doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(ls), 0) - coalesce(n, 0) AS BIGINT) AS n_dropped,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(t, '')) END AS kept_sha256
FROM l LEFT JOIN k USING (doc_id)
"""


@registry.add(OP2_SQL)
def op2_line_dedup(spark, sf_dir):
    found = lines.without_boilerplate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
o AS (SELECT t, min(page_id) AS original FROM p GROUP BY t)
SELECT page_id, CAST(strlen(p.t) AS BIGINT) AS payload_bytes,
       translate(array_to_string(list_transform(range(0, 8), lambda i:
         lpad(to_base(CAST('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT), 32), 4, '0')), ''),
         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM p JOIN o USING (t)
"""


@registry.add(OP7_SQL)
def op7_warc_revisits(spark, sf_dir):
    return warc.archived(spark, table(spark, sf_dir, "pages"))


OP1_SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS place, role, text
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
        WHERE conv_id IS NOT NULL)),
p AS (
  SELECT conv_id, place, max(place) OVER (PARTITION BY conv_id) AS last,
         string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY place) AS prefix
  FROM t),
first AS (SELECT min(conv_id) AS conv_id, last, prefix FROM p WHERE place = last GROUP BY last, prefix),
kept AS (
  SELECT conv_id, last FROM first ANTI JOIN (SELECT DISTINCT prefix FROM p WHERE place < last) q USING (prefix))
SELECT t.conv_id, place, last AS n_turns, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered
FROM t JOIN kept USING (conv_id)
"""


@registry.add(OP1_SQL)
def op1_chat_snapshots(spark, sf_dir):
    return chat.collapsed(table(spark, sf_dir, "conversations"))


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""


@registry.add(OP6_SQL)
def op6_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "id % 20 = 0")


@registry.add()
def op3_suffix_array_dedup(spark, sf_dir):
    found = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


@registry.add()
def op5_sentencepiece(spark, sf_dir, tokenizer: str = TOKENIZER):
    model = pieces.load(tokenizer)
    return pieces.encode(table(spark, sf_dir, "documents"), model, digests=True).drop("ids")


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
sums AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0),
held AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM d),
tf AS (SELECT doc_id, term, n, CAST(count(*) AS BIGINT) AS tf FROM held GROUP BY doc_id, term, n),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
asked AS (SELECT item_id, term, CAST(count(*) AS BIGINT) AS times FROM q GROUP BY item_id, term),
w AS (
  SELECT item_id, term, times, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM asked JOIN df USING (term), sums),
s AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM w JOIN tf USING (term), sums GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 20
"""


@registry.add(OP11_SQL)
def op11_ranked_search(spark, sf_dir):
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registry.add()
def op12_sharding(spark, sf_dir):
    found = shards.sharded(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: A byte's step of CRC-32 is eight of its bits: shifted, and combined with the polynomial where the last bit is 1.
OP13_SQL = r"""
WITH steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), b)) AS tab),
src AS (SELECT 'd' AS of, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
d AS (
  SELECT of, id, list_filter(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM src),
f AS (
  SELECT of, id, unnest(ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS feature FROM d),
n AS (SELECT of, id, feature, CAST(count(*) AS BIGINT) AS n FROM f GROUP BY of, id, feature),
hexed AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM n)),
bucketed AS (
  SELECT feature, xor(list_reduce(
    list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
  FROM hexed, steps),
c AS (
  SELECT bucket, coalesce(sum(n) FILTER (of = 'd'), 0) AS s, coalesce(sum(n) FILTER (of = 'b'), 0) AS t
  FROM n JOIN bucketed USING (feature) GROUP BY bucket),
g AS (
  SELECT bucket, floor(1000 * ln(CAST((t + 1) * ((SELECT sum(s) FROM c) + 10000) AS DOUBLE)
    / CAST((s + 1) * ((SELECT sum(t) FROM c) + 10000) AS DOUBLE))) AS gain FROM c),
w AS (
  SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
  FROM n JOIN bucketed USING (feature) JOIN g USING (bucket) WHERE of = 'd' GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST(CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN w ON doc_id = id),
placed AS (
  SELECT *, CASE WHEN n_features >= 39 THEN row_number() OVER (PARTITION BY n_features >= 39 ORDER BY score DESC, doc_id) END AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT count(*) FROM scored WHERE n_features >= 39) * 25 // 100 THEN place END AS rank
FROM placed
"""


@registry.add(OP13_SQL)
def op13_importance_resampling(spark, sf_dir):
    found = resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@registry.add(corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
