"""Registered queries of this subpackage, with DuckDB SQL where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (centroids, decontaminate, exact_dedup, html_extract, mixing, packing, secrets, simhash, suffix_dedup, token_align,
                         toxicity, url_filter, warc)
from tessera.llm.common import table

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return add


#: (action, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

OP1_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut
), rules(action, rhost, rpath) AS (VALUES %s
), judged AS (
  SELECT page_id, host, path,
         (SELECT arg_max(rhost || rpath, length(rhost || rpath)) FROM rules
          WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule FROM parts
)
SELECT j.page_id, j.host, j.path, j.rule, coalesce(r.action, 'allow') AS verdict
FROM judged j LEFT JOIN rules r ON r.rhost || r.rpath = j.rule
""" % ", ".join(str(r) for r in RULES)


@query("op1_url_filter", OP1_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([(h, p, a) for a, h, p in RULES], "host string, path string, action string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query("op3_html_extract")
def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@query("op4_exact_dedup", OP4_SQL)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


@query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[a-z0-9\x{80}-\x{10FFFF}]+') FROM benchmark
), lengths AS (SELECT DISTINCT least(len(w), 5) AS n FROM words WHERE kind = 'i' AND len(w) > 0
), sized AS (SELECT kind, id, w, least(len(w), 5) AS n FROM words WHERE kind = 'i' AND len(w) > 0
  UNION ALL SELECT kind, id, w, n FROM words JOIN lengths ON len(w) >= n WHERE kind = 'd'
), shingles AS (
  SELECT DISTINCT kind, id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s FROM sized
), sizes AS (SELECT id, count(*)::INTEGER AS shingles FROM shingles WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*)::INTEGER AS shared, any_value(z.shingles) AS shingles,
       count(*)::INTEGER / any_value(z.shingles) AS containment
FROM shingles i JOIN shingles d ON d.kind = 'd' AND i.kind = 'i' AND d.n = i.n AND d.s = i.s JOIN sizes z ON z.id = i.id
GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(z.shingles)
"""


@query("op6_decontaminate", OP6_SQL)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def mixing_sql(marginals=mixing.MARGINALS, sweeps: int = 40, seed: int = 7) -> str:
    """The raking, unrolled as a chain of CTEs."""
    names = [m.name for m in marginals]
    ctes = ["""toks AS (
  SELECT doc_id, text, source, lang, greatest(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')), 1) AS tokens
  FROM documents)""", """docs AS (
  SELECT doc_id, source, lang, tokens, CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table'
    WHEN contains(coalesce(text, ''), 'License') OR contains(coalesce(text, ''), 'rights reserved') THEN 'legal'
    WHEN tokens < 64 THEN 'note' WHEN tokens >= 1024 THEN 'long' ELSE 'prose' END AS topic FROM toks)""",
            f"cells AS (SELECT {', '.join(names)}, sum(tokens) AS tokens FROM docs GROUP BY ALL)"]
    for m in marginals:
        ctes.append(f"t_{m.name} AS (SELECT {m.name} AS v, pow(sum(tokens)::DOUBLE, {m.exponent}) "
                    f"/ sum(pow(sum(tokens)::DOUBLE, {m.exponent})) OVER () AS share FROM cells GROUP BY 1)")
    ctes.append("w0 AS (SELECT cells.*, " + ", ".join(f"t_{n}.share AS _{n}" for n in names) + ", tokens::DOUBLE AS weight FROM cells "
                + " ".join(f"JOIN t_{n} ON t_{n}.v IS NOT DISTINCT FROM cells.{n}" for n in names) + ")")
    for i in range(sweeps * len(names)):
        n = names[i % len(names)]
        ctes.append(f"w{i + 1} AS (SELECT * REPLACE (weight * _{n} / sum(weight) OVER (PARTITION BY {n}) AS weight) FROM w{i})")
    ctes.append(f"""rated AS (SELECT *, round(weight * (SELECT sum(tokens) FROM cells)::DOUBLE / tokens, {mixing.DIGITS}) AS rate
  FROM w{sweeps * len(names)})""")
    same = " AND ".join(f"r.{n} IS NOT DISTINCT FROM d.{n}" for n in names)
    return "WITH " + ",\n".join(ctes) + f""",
taken AS (SELECT d.*, r.rate, floor(r.rate)::BIGINT + CASE WHEN
    ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null') || ':{seed}'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0
    < r.rate - floor(r.rate) THEN 1 ELSE 0 END AS copies
  FROM docs d JOIN rated r ON {same})
SELECT doc_id, source, lang, topic, tokens, rate, copies::BIGINT AS copies, copies > 0 AS kept FROM taken"""


@query("op8_mixing", mixing_sql())
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample_plan(table(spark, sf_dir, "documents"))


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


@query("op10_warc")
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = warc.archive_pages(table(spark, sf_dir, "pages"))
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "range", "seq")


@query("op11_packing")
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


@query("op12_centroids")
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", centroids.digest(F.col("centroid"))).drop("centroid")


@query("op13_token_align")
def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"), keep_groups=False)
