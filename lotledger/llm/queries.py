"""Queries that apply each operator to its whole table, and their SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotledger.llm import (annsearch, decontam, density, exactdedup, fillmiddle, filteraudit, mixing, ngramjoin,
                           ordinal, packing, secretspans, urltree, warc)
from lotledger.llm.common import table

#: (host, path, verdict)
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
TOKENIZER = "byte_bpe_50k.json"


def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urltree.judged(table(spark, sf_dir, "pages"), RULES)


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"), min_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.digests(packing.packed(docs, public_tokenizers.path(TOKENIZER), added=True))


def op4_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annsearch.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.extracted(table(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.classes(table(spark, sf_dir, "documents"), hash_all=True)


def op7_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretspans.reported(table(spark, sf_dir, "documents"))


def op8_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "expected_grade", "p_good", "p_best", "keep")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.joined(table(spark, sf_dir, "documents"), n=3, t=90)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digests(decontam.matched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fillmiddle.digests(fillmiddle.transformed(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_url_templates, op2_warc_revisits, op3_packing, op4_learned_partitions, op5_text_density,
        op6_exact_dedup, op7_secret_spans, op8_fair_mix, op9_ordinal_quality, op10_ngram_join,
        op11_decontamination, op12_filter_audit, op13_fill_middle)}


# A SHA-1 in 40 hexadecimal digits as 32 base32 letters, five digits (20 bits) giving four letters.
_BASE32 = """list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(sha1(payload), 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4)::INT)) & 31), 1)),
    'string_agg', '')"""

ORACLES = {
    "op2_warc_revisits": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
     g AS (SELECT payload, max(page_id) AS first FROM p GROUP BY payload)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN g USING (payload)""",
    "op6_exact_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body)""",
    "op10_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(greatest(1, len(words) - 2)),
    lambda i: array_to_string(words[i + 1:i + 3], ' '))) AS gram
  FROM w WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 90 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (
  SELECT a AS node, b AS seen FROM e
  UNION
  SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT node, min(seen) AS least FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.least, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.node = d.doc_id""",
    "op11_decontamination": r"""
WITH i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
w AS (
  SELECT DISTINCT item, least(10, len(words)) AS size,
    unnest(list_transform(range(greatest(1, len(words) - 9)), lambda k: array_to_string(words[k + 1:k + 10], ' '))) AS gram
  FROM i WHERE len(words) > 0),
d AS (SELECT doc_id, row_number() OVER () AS nr, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
p AS (
  SELECT nr, size, k, array_to_string(words[k + 1:k + size], ' ') AS gram
  FROM (SELECT nr, size, words, unnest(range(len(words) - size + 1)) AS k FROM d, (SELECT DISTINCT size FROM w))),
m AS (SELECT nr, p.size, k, item FROM p JOIN w ON p.size = w.size AND p.gram = w.gram),
h AS (SELECT nr, count(DISTINCT place) AS n FROM (SELECT nr, unnest(range(k, k + size)) AS place FROM m) GROUP BY nr),
o AS (SELECT nr, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY nr)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(o.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (nr) LEFT JOIN o USING (nr)""",
    "op12_filter_audit": r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (
  SELECT part, len(words) < 50 AS A, 100 * len(list_distinct(words)) < 65 * len(words) AS B,
         100 * len(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * len(body) AS C, regexp_matches(body, '[#$%&*|]') AS D,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS E,
         EXISTS (FROM labels l WHERE l.doc_id = t.doc_id AND quality = 1) AS good,
         EXISTS (FROM labels l WHERE l.doc_id = t.doc_id AND toxic = 1) AS toxic
  FROM t),
g AS (SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: [A, B, C, D, E][i]) AS failed, count(*) AS n FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS letters FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT letters, unnest(range(1, 6))::INT AS step FROM o),
r AS (
  SELECT part, array_to_string(letters, '') AS filter_order, step, letters[step] AS own, n, good, toxic, failed,
         list_has_any(letters[1:step - 1], failed) AS earlier, list_contains(failed, letters[step]) AS fails
  FROM g, s),
q AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN NOT earlier AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT earlier AND fails THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN earlier AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN failed = [own] THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT earlier AND fails AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT earlier AND fails AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM r GROUP BY ALL)
SELECT * EXCLUDE own, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM q""",
    "op13_fill_middle": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents),
h AS (
  SELECT *, ('0x' || hex[1:8])::BIGINT % (len(tokens) + 1) AS x, ('0x' || hex[9:16])::BIGINT % (len(tokens) + 1) AS y,
         CASE WHEN body = '' OR regexp_matches(body, '<[PSM]>') OR ('0x' || hex[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || hex[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
c AS (
  SELECT *, array_to_string(tokens[1:least(x, y)], '') AS prefix,
         array_to_string(tokens[least(x, y) + 1:greatest(x, y)], '') AS middle,
         array_to_string(tokens[greatest(x, y) + 1:], '') AS suffix FROM h)
SELECT doc_id, len(tokens)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256 FROM c""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
