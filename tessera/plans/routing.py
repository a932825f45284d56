"""Routing query (E9: J8-J11) over requests derived from documents ⨝ labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import routing as R
from tessera.plans.registry import register
from tessera.sources.tables import read_table

# The installed systems of this site (a listing of the systems folder) and
# two site-specific multi-direction systems; the rest is the built-in registry.
INSTALLED = ["fren", "deen", "kkenru", "kken_query", "kaen_query", "fsen", "spen", "enps", "kaen"]
SITE_LANGS = {"esmulti": [("es", "en"), ("es", "fr")], "romance": [("es", "en"), ("fr", "es")]}


def demo_registry() -> R.Registry:
    reg = R.Registry(installed=list(INSTALLED))
    reg.system_to_langs.update(SITE_LANGS)
    return reg


def _values(rows, cols):
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(cols)}))"


def _route_sql() -> str:
    reg = demo_registry()
    dirs = [(k, f"{a}{b}") for k, v in reg.system_to_langs.items() for a, b in v]
    return f"""
WITH req AS (
  SELECT d.doc_id, d.lang AS src_lang, CASE WHEN d.lang = 'en' THEN 'kk' ELSE 'en' END AS tgt_lang,
         CASE WHEN l.quality = 1 THEN 'audio' ELSE 'text' END AS type, coalesce(l.toxic = 1, FALSE) AS query
  FROM documents d LEFT JOIN labels l USING (doc_id)),
audio_map AS {_values(reg.audio_map.items(), ['target', 'audio_system'])},
query_map AS {_values(reg.query_map.items(), ['target', 'query_system'])},
installed AS {_values([(s,) for s in reg.installed], ['system'])},
dirs AS {_values(dirs, ['cand', 'direction'])},
cands AS (SELECT direction, count(*) AS n_cand, min(cand) AS cand FROM dirs GROUP BY direction),
procs AS {_values([(k, v) for k, v in reg.processors.items() if k != 'DEFAULT'], ['system', 'processor'])},
alangs AS {_values([(k, a, b) for k, (a, b) in reg.audio_langs.items()], ['system', 'audio_src', 'audio_tgt'])},
pt AS {_values([(s,) for s in sorted(reg.passthrough)], ['system'])},
t0 AS (SELECT r.*, src_lang || tgt_lang AS target0 FROM req r),
t1 AS (SELECT t0.*, CASE WHEN type = 'audio' THEN coalesce(a.audio_system, target0) ELSE target0 END AS target1
       FROM t0 LEFT JOIN audio_map a ON a.target = t0.target0),
t2 AS (SELECT t1.*, CASE WHEN query THEN coalesce(q.query_system, target1) ELSE target1 END AS target
       FROM t1 LEFT JOIN query_map q ON q.target = t1.target1),
t3 AS (SELECT t2.*, i.system IS NOT NULL AS inst, coalesce(c.n_cand, 0) AS n, c.cand
       FROM t2 LEFT JOIN installed i ON i.system = t2.target LEFT JOIN cands c ON c.direction = t2.target),
t4 AS (SELECT t3.*, CASE WHEN inst THEN target WHEN n = 1 THEN cand END AS sys,
              CASE WHEN inst OR n = 1 THEN NULL WHEN n > 1 THEN 'ambiguous system for ' || target
                   ELSE 'unrecognized system: ' || target END AS error FROM t3)
SELECT t4.doc_id, t4.src_lang, t4.tgt_lang, t4.type, t4.query, t4.error, t4.sys AS system,
       CASE WHEN t4.sys IS NOT NULL THEN coalesce(p.processor, '{reg.processors['DEFAULT']}') END AS processor,
       CASE WHEN t4.type = 'audio' AND al.system IS NOT NULL THEN al.audio_src ELSE t4.src_lang END AS src_eff,
       CASE WHEN t4.type = 'audio' AND al.system IS NOT NULL THEN al.audio_tgt ELSE t4.tgt_lang END AS tgt_eff,
       pt.system IS NOT NULL AS passthrough
FROM t4 LEFT JOIN procs p ON p.system = t4.sys LEFT JOIN alangs al ON al.system = t4.sys
     LEFT JOIN pt ON pt.system = t4.sys
"""


@register("route_requests", _route_sql())
def route_requests(spark, sf_dir):
    """Every document becomes a request (audio = quality label, query = toxic label)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    req = (docs.join(labels, "doc_id", "left")
           .select("doc_id", F.col("lang").alias("src_lang"),
                   F.when(F.col("lang") == "en", F.lit("kk")).otherwise(F.lit("en")).alias("tgt_lang"),
                   F.when(F.col("quality") == 1, F.lit("audio")).otherwise(F.lit("text")).alias("type"),
                   F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("query"),
                   F.lit(None).cast("string").alias("system")))
    out = R.route(req, demo_registry())
    return out.select("doc_id", "src_lang", "tgt_lang", "type", "query", "error", "system", "processor",
                      "src_eff", "tgt_eff", "passthrough")
