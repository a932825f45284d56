"""Scoring queries.

Predictions and references come from ``conversations``: the assistant turn
k+1 is scored against the user turn k of the same conversation (the
segment key is ``(conv_id, turn)`` of the assistant turn).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import scorers, scoring
from tessera.plans.registry import register
from tessera.sources.tables import read_table


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn k ↔ assistant turn k+1 — an equi join on (conv_id, turn),
    so one very long conversation is still spread over many tasks."""
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    user = conv.filter(F.col("role") == "user").select("conv_id", (F.col("turn") + 1).alias("turn"),
                                                       F.col("text").alias("ref"))
    asst = conv.filter(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("hyp"))
    return asst.join(user, ["conv_id", "turn"])


def _q(s):
    return "'" + s.replace("'", "''") + "'"


def duck_tok13a(x: str) -> str:
    s = x
    for a, b in (("<skipped>", ""), ("-\n", ""), ("\n", " ")) + scoring.TOK13A_ENTITIES:
        s = f"replace({s}, {_q(a)}, {_q(b)})"
    s = f"(' ' || {s} || ' ')"
    for pat, rep in scoring.TOK13A_RULES:
        s = f"regexp_replace({s}, {_q(pat)}, {_q(rep.replace('$', chr(92)))}, 'g')"
    return f"CASE WHEN trim({s}) = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(trim({s}), '\\s+') END"


PAIRS_SQL = """
pairs AS (SELECT a.conv_id, a.turn, a.text AS hyp, u.text AS ref
          FROM conversations a JOIN conversations u ON a.conv_id = u.conv_id AND u.turn = a.turn - 1
          WHERE a.role = 'assistant' AND u.role = 'user')"""


def duck_bleu(group: str) -> str:
    """DuckDB BLEU per ``group`` (an expression over pairs) with the same smoothing."""
    ng = " UNION ALL ".join(
        f"SELECT g, conv_id, turn, {n} AS n, side, unnest(list_transform(range(1, len(tok) - {n} + 2), "
        f"lambda i: array_to_string(tok[i:i + {n - 1}], ' '))) AS gram FROM tk WHERE len(tok) >= {n}"
        for n in range(1, 5))
    prec = []
    zeros = "0"
    for n in range(1, 5):
        zeros = f"{zeros} + CASE WHEN c{n} = 0 THEN 1 ELSE 0 END"
        prec.append(f"CASE WHEN t{n} = 0 THEN 0.0 WHEN c{n} = 0 THEN 100.0 / (pow(2.0, {zeros}) * t{n}) "
                    f"ELSE 100.0 * c{n} / t{n} END AS p{n}")
    return f"""WITH {PAIRS_SQL.strip()},
seg AS (SELECT {group} AS g, conv_id, turn, {duck_tok13a('hyp')} AS th, {duck_tok13a('ref')} AS tr FROM pairs),
tk AS (SELECT g, conv_id, turn, 'h' AS side, th AS tok FROM seg UNION ALL SELECT g, conv_id, turn, 'r', tr FROM seg),
grams AS ({ng}),
cnt AS (SELECT g, conv_id, turn, n, gram, count_if(side = 'h') AS ch, count_if(side = 'r') AS cr
        FROM grams GROUP BY ALL),
pn AS (SELECT g, n, sum(least(ch, cr)) AS correct, sum(ch) AS total FROM cnt GROUP BY g, n),
lens AS (SELECT g, sum(len(th)) AS sys_len, sum(len(tr)) AS ref_len FROM seg GROUP BY g),
wide AS (SELECT l.g, l.sys_len, l.ref_len,
           {', '.join(f"coalesce(max(CASE WHEN n = {n} THEN correct END), 0) AS c{n}, coalesce(max(CASE WHEN n = {n} THEN total END), 0) AS t{n}" for n in range(1, 5))}
         FROM lens l LEFT JOIN pn USING (g) GROUP BY l.g, l.sys_len, l.ref_len),
pr AS (SELECT *, {', '.join(prec)},
              CASE WHEN sys_len >= ref_len THEN 1.0 WHEN sys_len = 0 THEN 0.0 ELSE exp(1.0 - ref_len / sys_len) END AS bp
       FROM wide)
SELECT g, round(CASE WHEN least(p1, p2, p3, p4) <= 0 THEN 0.0
                     ELSE bp * exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) END, 6) AS bleu,
       round(bp, 6) AS bp, CAST(sys_len AS BIGINT) AS sys_len, CAST(ref_len AS BIGINT) AS ref_len,
       round(p1, 6) AS p1, round(p2, 6) AS p2, round(p3, 6) AS p3, round(p4, 6) AS p4
FROM pr"""


@register("corpus_bleu", duck_bleu("0").replace("SELECT g, round(", "SELECT round(", 1))
def corpus_bleu(spark, sf_dir):
    """Corpus BLEU of assistant turns against the preceding user turns."""
    return scoring.corpus_bleu(turn_pairs(spark, sf_dir), [], ["conv_id", "turn"])


@register("bleu_by_test_set", duck_bleu("'t' || CAST(turn AS VARCHAR)").replace(
    "SELECT g, round(", "SELECT g AS test_set, round(", 1))
def bleu_by_test_set(spark, sf_dir):
    """One BLEU per test set (here: per exchange position), all sets in one job."""
    pairs = turn_pairs(spark, sf_dir).withColumn("test_set", F.concat(F.lit("t"), F.col("turn").cast("string")))
    return scoring.corpus_bleu(pairs, ["test_set"], ["conv_id", "turn"])


def query_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions (assistant turns) with query terms: the words of 12+
    characters of the preceding user turn, written ``t1 ||| t2 …``."""
    pairs = turn_pairs(spark, sf_dir)
    long_words = F.filter(T.tokens(F.col("ref")), lambda w: F.length(w) >= 12)
    return pairs.select("conv_id", "turn", "hyp", "ref", F.array_join(long_words, " ||| ").alias("query"))


QUERY_SQL = """WITH {pairs},
q AS (SELECT conv_id, turn, trim(hyp) AS h,
             array_to_string(list_filter(regexp_split_to_array(trim(ref), '\\s+'), lambda w: length(w) >= 12), ' ||| ') AS query
      FROM pairs),
t AS (SELECT {group} AS g, h, list_transform(string_split(trim(query), '|||'), lambda x: trim(x)) AS terms
      FROM q WHERE trim(query) <> ''),
s AS (SELECT g, len(terms) AS e,
             list_sum(list_transform(terms, lambda term: CASE WHEN length(term) = 0 THEN length(h) + 1
                      ELSE (length(h) - length(replace(h, term, ''))) // length(term) END)) AS i
      FROM t)
SELECT {sel} CAST(sum(i) AS BIGINT) AS inserted, CAST(sum(e) AS BIGINT) AS expected,
       round(avg(1.0 - abs(i - e) / e), 6) AS score
FROM s {groupby}"""


@register("query_term_score", QUERY_SQL.format(pairs=PAIRS_SQL.strip(), group="0", sel="", groupby=""))
def query_term_score(spark, sf_dir):
    """Query-term insertion metric over all predictions."""
    return scoring.query_term_scores(query_pairs(spark, sf_dir).withColumn("_all", F.lit(0)), ["_all"]).drop("_all")


@register("score_test_sets", """WITH b AS ({bleu}),
qs AS ({query})
SELECT g AS test_set, 'SacrebleuScorer' AS scorer, 'bleu' AS metric, bleu AS value FROM b
UNION ALL SELECT g, 'QueryScorer', 'inserted', CAST(inserted AS DOUBLE) FROM qs
UNION ALL SELECT g, 'QueryScorer', 'expected', CAST(expected AS DOUBLE) FROM qs
UNION ALL SELECT g, 'QueryScorer', 'score', score FROM qs""".format(
    bleu=duck_bleu("'t' || CAST(turn AS VARCHAR)").replace("WITH ", "WITH ", 1),
    query=QUERY_SQL.format(pairs=PAIRS_SQL.strip(), group="'t' || CAST(turn AS VARCHAR)", sel="g,",
                           groupby="GROUP BY g")))
def score_test_sets(spark, sf_dir):
    """Every test set × every configured scorer → long ``scores`` table."""
    pairs = query_pairs(spark, sf_dir).withColumn("test_set", F.concat(F.lit("t"), F.col("turn").cast("string")))
    bleu = scoring.corpus_bleu(pairs, ["test_set"], ["conv_id", "turn"])
    q = scoring.query_term_scores(pairs, ["test_set"])
    metrics = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in ("inserted", "expected", "score")])
    return (bleu.select("test_set", F.lit("SacrebleuScorer").alias("scorer"), F.lit("bleu").alias("metric"), F.col("bleu").alias("value"))
                .unionByName(q.select("test_set", F.lit("QueryScorer").alias("scorer"), F.explode(metrics).alias("m"))
                              .select("test_set", "scorer", "m.metric", "m.value")))


#: Sets of the catalogue by ``turn % 4``: which scorers, and whether BLEU compares lower-cased texts.
_LOWER = "CASE WHEN a.turn % 4 = 3 THEN lower({c}) ELSE {c} END"


@register("score_catalogue", """WITH b AS ({bleu}),
qs AS ({query}),
sets AS (SELECT DISTINCT 't' || CAST(a.turn AS VARCHAR) AS test_set, a.turn % 4 AS k FROM conversations a
         JOIN conversations u ON a.conv_id = u.conv_id AND u.turn = a.turn - 1 WHERE a.role = 'assistant' AND u.role = 'user')
SELECT test_set, 'SacrebleuScorer' AS scorer, 'bleu' AS metric, bleu AS value, NULL::VARCHAR AS error
FROM sets LEFT JOIN b ON g = test_set
UNION ALL SELECT test_set, 'QueryScorer', m, CASE m WHEN 'inserted' THEN coalesce(inserted, 0) WHEN 'expected' THEN coalesce(expected, 0)
                                             ELSE score END, NULL
FROM sets LEFT JOIN qs ON g = test_set, (SELECT unnest(['inserted', 'expected', 'score']) AS m) WHERE k = 1
UNION ALL SELECT test_set, 'TerScorer', NULL, NULL, 'no such scorer' FROM sets WHERE k = 3""".format(
    bleu=duck_bleu("'t' || CAST(turn AS VARCHAR)").replace(
        "a.text AS hyp, u.text AS ref", f"{_LOWER.format(c='a.text')} AS hyp, {_LOWER.format(c='u.text')} AS ref"),
    query=QUERY_SQL.format(pairs=PAIRS_SQL.strip(), group="'t' || CAST(turn AS VARCHAR)", sel="g,", groupby="GROUP BY g")))
def score_catalogue(spark, sf_dir):
    """A table says which set is scored by which registered scorer with which
    arguments; every exchange position is a set, and a scorer that nobody knows is an error row."""
    pairs = query_pairs(spark, sf_dir).withColumn("test_set", F.concat(F.lit("t"), F.col("turn").cast("string")))
    empty = F.lit(None).cast("map<string,string>")
    kind = F.col("turn") % 4
    scorer = F.struct(F.lit("SacrebleuScorer").alias("scorer"), F.when(kind == 3, F.create_map(F.lit("lowercase"), F.lit("true"))).alias("args"))
    others = F.when(kind == 1, F.array(F.struct(F.lit("QueryScorer").alias("scorer"), empty.alias("args")))).otherwise(
        F.when(kind == 3, F.array(F.struct(F.lit("TerScorer").alias("scorer"), empty.alias("args")))))
    asked = (pairs.select("test_set", "turn").distinct()
             .select("test_set", F.explode(F.concat(F.array(scorer), F.coalesce(others, F.array().cast(
                 "array<struct<scorer:string,args:map<string,string>>>")))).alias("s")).select("test_set", "s.*"))
    segments = pairs.select("test_set", "hyp", F.array("ref").alias("refs"), "query")
    return scorers.score(segments, asked)
