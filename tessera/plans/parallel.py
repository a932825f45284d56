"""Parallel data, multi-source, training preparation, sinks' formats, request
validation and vocabulary (S4, S5, S12, J3, J7, P11, P12, E7, K1-K3, K7, A11, F44)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import decode, wrap
from tessera.operators.translate import format_rows
from tessera.plans.corpus import lines_of, pieces_of
from tessera.plans.registry import register
from tessera.plans.sqlparts import LINES, PIECES, with_, pieces_sql
from tessera.sources.tables import read_table

CONV_PAIRS_SQL = """
pairs AS (SELECT a.conv_id, u.turn AS line_no, u.text AS src, a.text AS tgt
          FROM conversations a JOIN conversations u ON a.conv_id = u.conv_id AND u.turn = a.turn - 1
          WHERE a.role = 'assistant' AND u.role = 'user')"""
_BROKEN = "chr(13) || chr(8204) || chr(65279)"


def conv_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn k (source) ↔ assistant turn k+1 (target) as an aligned pair."""
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    src = conv.filter(F.col("role") == "user").select("conv_id", F.col("turn").alias("line_no"),
                                                      F.col("text").alias("src"))
    tgt = conv.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("line_no"),
                                                           F.col("text").alias("tgt"))
    return src.join(tgt, ["conv_id", "line_no"])


@register("parallel_pairs", "WITH " + CONV_PAIRS_SQL.strip() + f"""
SELECT conv_id, CAST(line_no AS BIGINT) AS line_no, translate(src, {_BROKEN}, '') AS src,
       translate(tgt, {_BROKEN}, '') AS tgt FROM pairs""")
def parallel_pairs(spark, sf_dir):
    """Aligned, repaired parallel pairs."""
    p = conv_pairs(spark, sf_dir)
    return p.select("conv_id", F.col("line_no").cast("long").alias("line_no"),
                    T.repair_chars(F.col("src")).alias("src"), T.repair_chars(F.col("tgt")).alias("tgt"))


@register("pair_length_check", """
SELECT conv_id, CAST(count_if(role = 'user') AS BIGINT) AS n_src, CAST(count_if(role = 'assistant') AS BIGINT) AS n_tgt,
       count_if(role = 'user') = count_if(role = 'assistant') AS ok
FROM conversations GROUP BY conv_id""")
def pair_length_check(spark, sf_dir):
    """A set (conversation) whose two sides differ in line count fails."""
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "role")
    return conv.groupBy("conv_id").agg(
        F.count_if(F.col("role") == "user").alias("n_src"), F.count_if(F.col("role") == "assistant").alias("n_tgt")
    ).withColumn("ok", F.col("n_src") == F.col("n_tgt"))


MULTI_MAX = 50


@register("multisource_align", "WITH " + CONV_PAIRS_SQL.strip() + r""",
lines AS (SELECT conv_id, line_no, replace(src, chr(10), ' ') AS text, tgt FROM pairs),
_t AS (SELECT *, CASE WHEN trim(text) = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(trim(text), '\s+') END AS tok
       FROM lines),
_w AS (SELECT conv_id, line_no, tgt, CASE WHEN len(tok) > 50
              THEN list_transform(range(0, (len(tok) - 1) // 50 + 1),
                                  lambda i: array_to_string(tok[i * 50 + 1 : i * 50 + 50], ' '))
              ELSE [trim(text)] END AS p FROM _t)
SELECT conv_id, CAST(line_no AS BIGINT) AS line_no, CAST(unnest(range(0, len(p))) AS INTEGER) AS piece_no,
       unnest(p) AS src, tgt AS extra
FROM _w""")
def multisource_align(spark, sf_dir):
    """Main source wrapped at 50 tokens; the extra source's line i is
    repeated for every piece of main line i (a keyed left join)."""
    pairs = conv_pairs(spark, sf_dir)
    main = pairs.select("conv_id", "line_no", F.regexp_replace("src", "\n", " ").alias("text"))
    extra = pairs.select("conv_id", "line_no", F.col("tgt").alias("extra"))
    pieces = wrap.wrap_lines(main, keys=("conv_id", "line_no"), max_length=MULTI_MAX)
    return (pieces.join(extra, ["conv_id", "line_no"], "left")
            .select("conv_id", F.col("line_no").cast("long").alias("line_no"), "piece_no",
                    F.col("text").alias("src"), "extra"))


@register("prepare_training", "WITH " + CONV_PAIRS_SQL.strip() + f""",
chk AS (SELECT conv_id, count_if(role = 'user') = count_if(role = 'assistant') AS ok
        FROM conversations GROUP BY conv_id)
SELECT CASE WHEN conv_id % 10 = 0 THEN 'valid' ELSE 'train' END AS "set", conv_id, CAST(line_no AS BIGINT) AS line_no,
       trim(regexp_replace(translate(src, {_BROKEN}, ''), '\\s+', ' ', 'g')) AS input,
       trim(regexp_replace(translate(tgt, {_BROKEN}, ''), '\\s+', ' ', 'g')) AS output,
       CASE WHEN conv_id % 10 = 0 THEN translate(tgt, {_BROKEN}, '') END AS ref
FROM pairs JOIN chk USING (conv_id) WHERE ok""")
def prepare_training(spark, sf_dir):
    """Repair → per-set length check (strict: failing sets are left
    out) → pre-process both sides → train/valid rows with the raw valid REF.
    Every tenth conversation is the validation set."""
    pairs = conv_pairs(spark, sf_dir)
    ok = pair_length_check(spark, sf_dir).filter("ok").select("conv_id")
    src, tgt = T.repair_chars(F.col("src")), T.repair_chars(F.col("tgt"))
    is_valid = F.col("conv_id") % 10 == 0
    return (pairs.join(ok, "conv_id", "left_semi")
            .select(F.when(is_valid, F.lit("valid")).otherwise(F.lit("train")).alias("set"), "conv_id",
                    F.col("line_no").cast("long").alias("line_no"), T.collapse_ws(src).alias("input"),
                    T.collapse_ws(tgt).alias("output"), F.when(is_valid, tgt).alias("ref")))


ROUNDTRIP_SQL = with_(LINES, PIECES) + r"""
, _lines AS (SELECT doc_id, line_no, bool_or(is_empty) AS is_empty,
                    string_agg(trim(text), ' ' ORDER BY piece_no) AS joined FROM pieces GROUP BY 1, 2),
 rt AS (SELECT doc_id, line_no, CAST(0 AS INTEGER) AS rank, CASE WHEN is_empty THEN '' ELSE joined END AS translation
        FROM _lines)
"""


def _roundtrip_1best(spark, sf_dir):
    return wrap.unwrap_pieces(decode.echo_decode(pieces_of(spark, sf_dir), n_best=1))


@register("format_marian", ROUNDTRIP_SQL + "SELECT doc_id, CAST(line_no AS VARCHAR) || ' ||| ' || trim(translation) AS line FROM rt")
def format_marian(spark, sf_dir):
    """K2/L4: ``id ||| translation`` rows of every document."""
    r = _roundtrip_1best(spark, sf_dir)
    return format_rows(r, "marian").select("doc_id", F.col("value").alias("line"))


@register("format_json", ROUNDTRIP_SQL + "SELECT doc_id, json_object('id', line_no, 'translation', translation)::VARCHAR AS line FROM rt")
def format_json(spark, sf_dir):
    """Json-lines rows with sorted keys (``id``, ``translation``)."""
    r = _roundtrip_1best(spark, sf_dir)
    return format_rows(r, "json").select("doc_id", F.col("value").alias("line"))


@register("format_text", ROUNDTRIP_SQL + "SELECT doc_id, line_no, trim(translation) AS line FROM rt")
def format_text(spark, sf_dir):
    """K3: plain text rows."""
    r = _roundtrip_1best(spark, sf_dir)
    return format_rows(r, "text").select("doc_id", "line_no", F.col("value").alias("line"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D11 requests from conversation turns: user turns carry one query per
    line (the line's first word), system turns a single query line, assistant
    turns none."""
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    lines = T.split_message(F.col("text"))
    first_words = F.transform(lines, lambda l: F.coalesce(F.get(F.split(T.strip(l), " "), 0), F.lit("")))
    query = (F.when(F.col("role") == "user", F.array_join(first_words, "\n"))
             .when(F.col("role") == "system", F.lit("sys")))
    return conv.select("conv_id", "turn", "text", query.alias("query"))


@register("request_validation", r"""
WITH m AS (SELECT conv_id, turn, text,
                  CASE WHEN role = 'user' THEN array_to_string(list_transform(string_split(trim(text), chr(10)),
                           lambda l: coalesce(string_split(trim(l), ' ')[1], '')), chr(10))
                       WHEN role = 'system' THEN 'sys' END AS query FROM conversations),
v AS (SELECT *, string_split(trim(text), chr(10)) AS lines,
             CASE WHEN query IS NULL THEN NULL ELSE string_split(trim(query), chr(10)) END AS qs FROM m),
e AS (SELECT *, CASE WHEN qs IS NOT NULL AND len(qs) <> len(lines) THEN 'number of queries does not match number of lines' END AS error FROM v)
SELECT conv_id, turn, CAST(-1 AS BIGINT) AS line_no, NULL::VARCHAR AS text, error FROM e WHERE error IS NOT NULL
UNION ALL
SELECT conv_id, turn, CAST(unnest(range(0, len(lines))) AS BIGINT) AS line_no,
       unnest(list_transform(range(1, len(lines) + 1), lambda i: CASE WHEN qs IS NULL THEN trim(lines[i])
            ELSE trim(lines[i]) || ' ||| ' || trim(qs[i]) END)) AS text, NULL AS error
FROM e WHERE error IS NULL""")
def request_validation(spark, sf_dir):
    """Split messages into lines, pair each line with its query
    (``arrays_zip``, no shuffle); a query count mismatch yields one error row."""
    m = messages(spark, sf_dir)
    lines = T.split_message(F.col("text"))
    qs = F.when(F.col("query").isNotNull(), T.split_message(F.col("query")))
    m = m.select("conv_id", "turn", lines.alias("lines"), qs.alias("qs"))
    err = F.when(F.col("qs").isNotNull() & (F.size("qs") != F.size("lines")),
                 F.lit("number of queries does not match number of lines"))
    m = m.withColumn("error", err)
    # an error row belongs to the whole message: line id -1 (no line)
    bad = m.filter(F.col("error").isNotNull()).select(
        "conv_id", "turn", F.lit(-1).cast("long").alias("line_no"), F.lit(None).cast("string").alias("text"), "error")
    good = m.filter(F.col("error").isNull())
    zipped = F.arrays_zip(F.col("lines").alias("l"), F.coalesce(F.col("qs"), F.array().cast("array<string>")).alias("q"))
    rows = good.select("conv_id", "turn", "qs", F.posexplode(zipped).alias("line_no", "z"))
    text = F.when(F.col("qs").isNull(), T.strip(F.col("z.l"))).otherwise(
        T.append_query(F.concat_ws("\t", F.col("z.l"), F.col("z.q"))))
    return bad.unionByName(rows.select("conv_id", "turn", F.col("line_no").cast("long").alias("line_no"),
                                       text.alias("text"), F.lit(None).cast("string").alias("error")))


VOCAB_THRESHOLD = 5


@register("vocab_threshold", with_(LINES) + f"""
SELECT token, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest(regexp_split_to_array(trim(lower(text)), '\\s+')) AS token FROM lines WHERE trim(text) <> '')
GROUP BY token HAVING count(*) >= {VOCAB_THRESHOLD}""")
def vocab_threshold(spark, sf_dir):
    """Lower-cased token counts, kept at frequency ≥ 5 (map-side partial counts)."""
    toks = lines_of(spark, sf_dir).select(F.explode(T.tokens(F.lower("text"))).alias("token"))
    return toks.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= VOCAB_THRESHOLD)


# --- case model and truecasing (N1, F38, F39, J14, W9) ---------------------
from tessera.operators import truecase as TC  # noqa: E402

TOKENS_SQL = with_(LINES) + r"""
, tk AS (SELECT doc_id, line_no, CASE WHEN trim(text) = '' THEN []::VARCHAR[]
                                      ELSE regexp_split_to_array(trim(text), '\s+') END AS tok FROM lines),
 toks AS (SELECT doc_id, line_no, CAST(unnest(range(0, len(tok))) AS INTEGER) AS pos,
                 unnest(list_transform(range(1, len(tok) + 1), lambda i:
                   {'token': tok[i], 'initial': i = 1 OR regexp_matches(tok[i - 1], '[.!?:]$')})) AS t FROM tk),
 tokens AS (SELECT doc_id, line_no, pos, t.token AS token, t.initial AS initial FROM toks),
 forms AS (SELECT lower(token) AS lc, token AS surface, count(*) AS n FROM tokens WHERE NOT initial GROUP BY 1, 2),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY lc ORDER BY n DESC, surface) AS r FROM forms),
 model AS (SELECT lc, max(CASE WHEN r = 1 THEN surface END) AS best, max(CASE WHEN r = 1 THEN n END) AS n_best,
                  sum(n) AS n_total, list_sort(list(surface)) AS forms FROM ranked GROUP BY lc)
"""


@register("case_model", TOKENS_SQL + """
SELECT lc, best, CAST(n_best AS BIGINT) AS n_best, CAST(n_total AS BIGINT) AS n_total,
       CAST(len(forms) AS INTEGER) AS n_forms FROM model""")
def case_model(spark, sf_dir):
    """Casing statistics of every word type from non-initial tokens."""
    model = TC.case_model(TC.token_table(lines_of(spark, sf_dir)))
    return model.select("lc", "best", "n_best", "n_total", F.size("forms").alias("n_forms"))


@register("truecase_lines", TOKENS_SQL + """
, cased AS (SELECT t.doc_id, t.line_no, t.pos,
                   CASE WHEN t.initial THEN coalesce(m.best, t.token)
                        WHEN list_contains(m.forms, t.token) THEN t.token
                        ELSE coalesce(m.best, t.token) END AS w
            FROM tokens t LEFT JOIN model m ON m.lc = lower(t.token)),
 tc AS (SELECT l.doc_id, l.line_no, coalesce(string_agg(c.w, ' ' ORDER BY c.pos), '') AS text
        FROM lines l LEFT JOIN cased c USING (doc_id, line_no) GROUP BY l.doc_id, l.line_no)
SELECT doc_id, line_no, text, upper(left(text, 1)) || substr(text, 2) AS detruecased FROM tc""")
def truecase_lines(spark, sf_dir):
    """F38/J14 then F39: truecase every line with the corpus case model, and
    the detruecased (sentence-start upper-cased) form."""
    lines = lines_of(spark, sf_dir)
    out = TC.truecase_lines(lines, TC.case_model(TC.token_table(lines)))
    return out.select("doc_id", "line_no", "text", T.detruecase(F.col("text")).alias("detruecased"))


from tessera.operators import bpe as BPE  # noqa: E402

BPE_MERGES = 20


@register("validate_dev_set")
def validate_dev_set(spark, sf_dir):
    """Decoder output in training form (tokenised, lower-cased,
    BPE-split) → BPE decode → detruecase → detokenise → corpus BLEU against
    the raw references.  Rows-only: the tokeniser is a documented rule subset."""
    from tessera.functions import processors as P
    from tessera.operators import scoring
    from tessera.plans.scoring import turn_pairs
    pairs = turn_pairs(spark, sf_dir)
    hyp_lines = pairs.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("line_no"),
                             F.lower(P.tokenize(F.regexp_replace("hyp", "\n", " "))).alias("text"))
    encoded = BPE.encode_corpus(hyp_lines, BPE.learn_merges(hyp_lines, BPE_MERGES))
    post = P.chain(T.bpe_decode, T.detruecase, P.detokenize)
    decoded = encoded.select(F.col("doc_id").alias("conv_id"), F.col("line_no").alias("turn"),
                             post(F.col("text")).alias("hyp"))
    segs = decoded.join(pairs.select("conv_id", "turn", "ref"), ["conv_id", "turn"])
    return scoring.corpus_bleu(segs, [], ["conv_id", "turn"])
