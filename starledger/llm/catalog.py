"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from starledger.llm import (
    decontam, divergence, fingerprint, html_extract, mixing, periodic_runs, quality, simhash, suffix_dedup, token_count, topk, url_filter, warc,
)
from starledger.llm.common import read_table, ship_package

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        _QUERIES[name] = run
        return fn
    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


@_query("op1_url_filter")
def op1(spark, sf_dir):
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), url_filter.labelled_urls(spark))


@_query("op2_mixing")
def op2(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "source", "mix_slot", "mix_position")


@_query("op3_quality")
def op3(spark, sf_dir):
    return quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_query("op4_decontam")
def op4(spark, sf_dir):
    return decontam.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@_query("op5_token_count")
def op5(spark, sf_dir):
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"))


@_query("op6_warc")
def op6(spark, sf_dir):
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


@_query("op7_suffix_dedup")
def op7(spark, sf_dir):
    return suffix_dedup.judge(read_table(spark, sf_dir, "documents"))


@_query("op8_simhash")
def op8(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@_query("op9_html_extract")
def op9(spark, sf_dir):
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


@_query("op10_topk")
def op10(spark, sf_dir):
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


@_query("op11_divergence")
def op11(spark, sf_dir):
    return divergence.audit(read_table(spark, sf_dir, "documents"))


@_query("op12_periodic_runs")
def op12(spark, sf_dir):
    found = periodic_runs.periodic_runs(read_table(spark, sf_dir, "documents"), edit=periodic_runs.planted)
    return periodic_runs.digests(found)


@_query("op13_fingerprint")
def op13(spark, sf_dir):
    return fingerprint.digests(fingerprint.edited_fingerprints(read_table(spark, sf_dir, "documents")))


@_query("pipeline")
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


ORACLE: dict[str, str] = {
    "op2_mixing": """
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS s,
         md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS h FROM documents),
c AS (SELECT s, count(*) AS n FROM d GROUP BY s),
w AS (SELECT s, n, greatest(1, CAST(round(pow(n, 0.7) / (SELECT sum(pow(n, 0.7)) FROM c) * 1000) AS BIGINT)) AS a FROM c),
l AS (SELECT list(s ORDER BY s) AS ss, list(a ORDER BY s) AS aa, CAST(sum(a) AS BIGINT) AS q FROM w),
edf(t, done, picks) AS (
  SELECT CAST(0 AS BIGINT), list_transform(aa, lambda x: CAST(0 AS BIGINT)), CAST([] AS BIGINT[]) FROM l
  UNION ALL
  SELECT t + 1, list_transform(done, lambda x, i: x + CASE WHEN i = p THEN 1 ELSE 0 END), list_append(picks, p)
  FROM (SELECT t, done, picks, list_min(list_transform(
               list_filter(range(1, len(aa) + 1), lambda i: done[i] < aa[i] AND (done[i] * q) // aa[i] <= t),
               lambda i: (((done[i] + 1) * q + aa[i] - 1) // aa[i]) * 100000 + i)) % 100000 AS p
        FROM edf, l WHERE t < q)),
f AS (SELECT ss[picks[x.t + 1]] AS s, x.t AS slot, row_number() OVER (PARTITION BY picks[x.t + 1] ORDER BY x.t) - 1 AS nth
      FROM (SELECT unnest(range(0, q)) AS t FROM l) AS x, (SELECT picks FROM edf, l WHERE edf.t = q) AS e, l),
r AS (SELECT doc_id, source, s, row_number() OVER (PARTITION BY s ORDER BY h, doc_id, text) - 1 AS i FROM d)
SELECT doc_id, source, CAST(((i // 64) // a) * q + slot AS BIGINT) AS mix_slot,
       CAST((((i // 64) // a) * q + slot) * 64 + i % 64 AS BIGINT) AS mix_position
FROM r JOIN w USING (s) JOIN f ON f.s = r.s AND f.nth = (i // 64) % a, l""",
    "op6_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS h, min(page_id) OVER (PARTITION BY b) AS first FROM p),
e AS (SELECT *, list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform([15, 10, 5, 0],
        lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT) >> s) & 31 AS BIGINT) + 1, 1)),
        'string_agg', '')), 'string_agg', '') AS payload_digest FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, 'ok' AS status FROM e""",
    "op10_topk": """
WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id AS vec_id,
             CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])) AS BIGINT) AS score
      FROM x AS q JOIN x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""",
    "op11_divergence": """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM d),
kept AS (SELECT lang, t, count(*) AS lc FROM w GROUP BY lang, t HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*) AS v, CAST(sum(lc) AS HUGEINT) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, t, count(*) AS gc FROM w GROUP BY ALL),
gt AS (SELECT g.lang, g.source, k.t, coalesce(c.gc, 0) AS gc, k.lc
       FROM g JOIN kept AS k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t),
p AS (SELECT gt.lang, gt.source, gt.t, gc,
             1 + (CAST(1000000000 AS HUGEINT) * (gc + 5)) // (CAST(sum(gc) OVER (PARTITION BY gt.lang, gt.source) AS HUGEINT) + 5 * v) AS p,
             1 + (CAST(1000000000 AS HUGEINT) * (lc + 5)) // (n + 5 * v) AS q
      FROM gt JOIN l ON l.lang = gt.lang),
f AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
      FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
          FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
u AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
      UNION ALL SELECT lang, source, 'term', t, CAST(p - q AS BIGINT) FROM p WHERE gc > 0 AND p > q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
WHERE part = 'pair' OR rank <= 50""",
}
