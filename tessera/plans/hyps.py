"""Decoder-output queries.

The driver tables hold no decoder output, so each query first derives one
from a table (FIXTURES B): two hypotheses per turn or per piece — the text and
its lower-cased form — written in the decoder's text formats, one row per
output line with a dense line number per output file.  The parsers then see
exactly what a decoder would have written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import nbest, prefix, wrap
from tessera.operators.translate import format_rows, translate_lines
from tessera.plans.corpus import BLANKED, lines_with_blanks, local_items
from tessera.plans.registry import register
from tessera.plans.sqlparts import LINES, pieces_sql, with_
from tessera.session import stored
from tessera.sources.tables import read_table


def _hyp(text_col: str = "text"):
    return F.regexp_replace(F.col(text_col), "\n", " ")


def nbest_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_out`` in n-best format: 2 lines per turn, ``seq = 2 * turn + rank``."""
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    r = F.explode(F.array(F.lit(0), F.lit(1))).alias("r")
    rows = conv.select("conv_id", "turn", "text", _hyp().alias("h"), r)
    hyp = F.when(F.col("r") == 0, F.col("h")).otherwise(F.lower("h"))
    line = F.concat_ws(" ||| ", F.col("turn").cast("string"), hyp,
                       F.concat(F.lit("F0= -"), (F.length("text") % 97).cast("string"), F.lit(".25")),
                       F.concat(F.lit("-"), ((F.length("text") + 7 * F.col("r")) % 89).cast("string"), F.lit(".5")))
    return rows.select(F.col("conv_id").alias("src_file"), (F.col("turn") * 2 + F.col("r")).cast("long").alias("seq"),
                       line.alias("line"))


NBEST_RAW_SQL = r"""
raw AS (SELECT conv_id AS src_file, turn * 2 + r AS seq,
               CAST(turn AS VARCHAR) || ' ||| ' || CASE WHEN r = 0 THEN h ELSE lower(h) END
               || ' ||| F0= -' || CAST(length(text) % 97 AS VARCHAR) || '.25'
               || ' ||| -' || CAST((length(text) + 7 * r) % 89 AS VARCHAR) || '.5' AS line
        FROM (SELECT *, replace(text, chr(10), ' ') AS h FROM conversations),
             (SELECT unnest([0, 1]) AS r)),
parsed AS (SELECT src_file, CAST(seq // 2 AS BIGINT) AS item, CAST(seq % 2 AS INTEGER) AS rank,
                  split_part(line, ' ||| ', 2) AS translation, split_part(line, ' ||| ', 3) AS features,
                  split_part(line, ' ||| ', 4) AS score FROM raw)
"""


@register("nbest_parse", with_(NBEST_RAW_SQL) + "SELECT * FROM parsed")
def nbest_parse(spark, sf_dir):
    """Parse 2-best ``id ||| text ||| F0 ||| score`` output."""
    return nbest.parse_nbest(nbest_raw(spark, sf_dir), n_best=2)


@register("nbest_topk", with_(NBEST_RAW_SQL) + r"""
SELECT src_file, item, CAST(rn - 1 AS INTEGER) AS rank, translation, score FROM (
  SELECT *, row_number() OVER (PARTITION BY src_file, item ORDER BY CAST(score AS DOUBLE) DESC, rank) AS rn
  FROM parsed) WHERE rn <= 1
""")
def nbest_topk(spark, sf_dir):
    """L2: keep the best hypothesis of each item by decoder score."""
    hyps = nbest.parse_nbest(nbest_raw(spark, sf_dir), n_best=2)
    return nbest.top_k(hyps, 1).select("src_file", "item", "rank", "translation", "score")


BLOCK_EXTRA = 3      # lines of a block beside its tokens': header, end token, blank


def words_block_lines(hyp: F.Column, item: F.Column) -> F.Column:
    """One n-best-words block: header, one line per token (alternatives: the
    token and its lower-cased form), the end token, a closing blank line."""
    toks = T.tokens(hyp)
    header = F.concat_ws(" ||| ", item.cast("string"), hyp, F.lit("F0= 0"), F.lit("-1"))
    tok_lines = F.transform(toks, lambda w: F.concat(w, F.lit(" |||  "), w, F.lit(" -0.5 "), F.lower(w),
                                                      F.lit(" -1.5")))
    return F.concat(F.array(header), tok_lines, F.array(F.lit("</s> |||  </s> -0.1"), F.lit("")))


def words_raw(units: DataFrame, file: str, order: str, text: str = "text") -> DataFrame:
    """Write 2-best n-best-words output for every unit (turn or piece).

    ``seq`` is dense per ``file``: the line count of each unit is prefix
    summed over ``order`` within the file (bucketed, skew-safe).  Only the
    text is shuffled; its lines, several times as long, are written after.
    """
    blocks = F.concat(words_block_lines(F.col(text), F.col(order)),
                      words_block_lines(F.lower(F.col(text)), F.col(order)))
    tokens = [F.size(T.tokens(F.col(text))), F.size(T.tokens(F.lower(F.col(text))))]
    per_unit = units.select(file, order, F.col(text).alias(text), (tokens[0] + tokens[1] + 2 * BLOCK_EXTRA).alias("_n"))
    starts = prefix.prefix_sum(per_unit, order, "_n", "_first", group=[file])
    return (starts.select(F.col(file).alias("src_file"), "_first", F.posexplode(blocks).alias("_pos", "line"))
            .select("src_file", (F.col("_first") + F.col("_pos")).cast("long").alias("seq"), "line"))


@register("nbest_words_blocks", r"""
WITH u AS (SELECT conv_id AS src_file, turn, r, CASE WHEN r = 0 THEN h ELSE lower(h) END AS hyp
           FROM (SELECT *, replace(text, chr(10), ' ') AS h FROM conversations), (SELECT unnest([0, 1]) AS r)),
t AS (SELECT *, CASE WHEN trim(hyp) = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(trim(hyp), '\s+') END AS tok
      FROM u)
SELECT src_file, CAST(turn AS BIGINT) AS item, CAST(r AS INTEGER) AS rank, array_to_string(tok, ' ') AS translation,
       CAST(len(tok) + 1 AS INTEGER) AS n_positions,
       array_to_string(list_append(list_transform(tok, lambda w:
           CASE WHEN w = lower(w) THEN w || '=-1.5'
                ELSE array_to_string(list_sort([w || '=-0.5', lower(w) || '=-1.5']), ' ') END), '</s>=-0.1'), ' | ')
         AS words
FROM t
""")
def nbest_words_blocks(spark, sf_dir):
    """Parse 2-best n-best-words blocks built from conversations."""
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", _hyp().alias("text"))
    raw = stored(words_raw(conv, "conv_id", "turn"), "words")       # the stored decoder output
    parsed = nbest.parse_nbest_words(raw, n_best=2)
    return parsed.select("src_file", "item", "rank", "translation",
                         F.size("nbest_words").alias("n_positions"),
                         nbest.canonical_words(F.col("nbest_words")).alias("words"))


@register("nbest_zip_expand", with_(LINES, BLANKED, pieces_sql("blanked")) + r"""
, pt AS (SELECT *, CASE WHEN trim(text) = '' THEN 0 ELSE len(regexp_split_to_array(trim(text), '\s+')) END AS nt
         FROM pieces),
 per_line AS (SELECT doc_id, line_no, bool_or(is_empty) AS is_empty,
                     string_agg(trim(text), ' ' ORDER BY piece_no) AS joined, sum(nt + 1) AS nw
              FROM pt GROUP BY 1, 2)
SELECT doc_id, line_no, CAST(r AS INTEGER) AS rank,
       CASE WHEN is_empty THEN '' WHEN r = 0 THEN joined ELSE lower(joined) END AS translation,
       CAST(CASE WHEN is_empty THEN 0 ELSE nw END AS INTEGER) AS n_words
FROM per_line, (SELECT unnest([0, 1]) AS r)
""")
def nbest_zip_expand(spark, sf_dir):
    """Stored n-best-words output per document → parse → J1 → zip ranks, blank empties, expand."""
    pieces = stored(local_items(wrap.wrap_lines(lines_with_blanks(spark, sf_dir))), "pieces")   # stage table
    raw = stored(words_raw(pieces.select("doc_id", "local_item", "text"), "doc_id", "local_item"), "words")
    parsed = nbest.parse_nbest_words(raw, n_best=2)
    hyps = parsed.join(pieces.drop("text").withColumnRenamed("doc_id", "src_file")
                       .withColumnRenamed("local_item", "item"), ["src_file", "item"])
    out = wrap.unwrap_pieces(hyps.withColumnRenamed("src_file", "doc_id"), words="nbest_words")
    return out.select("doc_id", "line_no", "rank", "translation", F.size("nbest_words").alias("n_words"))


# The JSON of a piece's word lists: its positions (the token and its lower-cased form, in the order of
# their text), then the end token; ``{tok}`` is a list of tokens.
_WORDS_JSON = r"""array_to_string(list_append(list_transform({tok}, lambda w: CASE WHEN w = lower(w)
      THEN '{' || to_json(w)::VARCHAR || ':"-1.5"}'
      WHEN w < lower(w) THEN '{' || to_json(w)::VARCHAR || ':"-0.5",' || to_json(lower(w))::VARCHAR || ':"-1.5"}'
      ELSE '{' || to_json(lower(w))::VARCHAR || ':"-1.5",' || to_json(w)::VARCHAR || ':"-0.5"}' END),
    '{"</s>":"-0.1"}'), ',')"""

_HYPS_SQL = r"""
, r AS (SELECT unnest([0, 1]) AS r),
 h AS (SELECT p.*, r.r, CASE WHEN r = 0 THEN trim(text) ELSE lower(trim(text)) END AS t FROM pieces p, r),
 ht AS (SELECT *, CASE WHEN t = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(t, '\s+') END AS wt FROM h),
 hw AS (SELECT *, """ + _WORDS_JSON.replace("{tok}", "wt") + r""" AS wj FROM ht),
 per_rank AS (SELECT doc_id, line_no, r, bool_or(is_empty) AS e,
                     CASE WHEN bool_or(is_empty) THEN '' ELSE string_agg(t, ' ' ORDER BY piece_no) END AS translation,
                     CASE WHEN bool_or(is_empty) THEN '[]'
                          ELSE '[' || string_agg(wj, ',' ORDER BY piece_no) || ']' END AS words
              FROM hw GROUP BY 1, 2, 3)
"""


@register("words_json", with_(LINES, BLANKED, pieces_sql("blanked")) + _HYPS_SQL + r"""
SELECT doc_id, CAST(r AS INTEGER) AS rank,
       '{"id":' || line_no || ',"nbest_words":' || words || ',"translation":' || to_json(translation)::VARCHAR || '}' AS line
FROM per_rank
""")
def words_json(spark, sf_dir):
    """E1/K1/P8 with words: lines (some blank) → wrap → 2-best decoder with word
    alternatives → zip ranks → JSON rows; every word list is compared."""
    out = translate_lines(lines_with_blanks(spark, sf_dir), ("doc_id", "line_no"), n_best=2, words=True)
    return format_rows(out, "json").select("doc_id", "rank", F.col("value").alias("line"))


#: Turns are shorter than the default wrap length; this one cuts most of them into pieces.
TURN_LENGTH = 40


@register("words_json_arrays", "WITH " + pieces_sql("turns").replace("> 200", f"> {TURN_LENGTH}").replace(
    "// 200", f"// {TURN_LENGTH}").replace("i * 200 + 200", f"i * {TURN_LENGTH} + {TURN_LENGTH}").replace(
    "i * 200 + 1", f"i * {TURN_LENGTH} + 1").replace("_t AS (", r"""
turns AS (SELECT conv_id AS doc_id, turn AS line_no,
                 CASE WHEN turn % 5 = 4 THEN '' ELSE replace(text, chr(10), ' ') END AS text FROM conversations),
_t AS (""", 1) + _HYPS_SQL + r"""
SELECT doc_id, '{"id":' || line_no || ',"nbest_words":[' || string_agg(words, ',' ORDER BY r) || '],"translation":['
               || string_agg(to_json(translation)::VARCHAR, ',' ORDER BY r) || ']}' AS line
FROM per_rank GROUP BY doc_id, line_no
""")
def words_json_arrays(spark, sf_dir):
    """S9/J1/P8 unexpanded: stored n-best-words blocks of wrapped turns (every fifth
    one blank) → parse → zip ranks, one JSON row a turn with arrays by rank."""
    text = F.when(F.col("turn") % 5 == 4, F.lit("")).otherwise(_hyp())
    turns = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"),
                                                              F.col("turn").cast("long").alias("line_no"), text.alias("text"))
    pieces = stored(local_items(wrap.wrap_lines(turns, max_length=TURN_LENGTH)), "pieces")     # stage table
    raw = stored(words_raw(pieces.select("doc_id", "local_item", "text"), "doc_id", "local_item"), "words")
    parsed = nbest.parse_nbest_words(raw, n_best=2)
    hyps = parsed.join(pieces.drop("text").withColumnRenamed("doc_id", "src_file")
                       .withColumnRenamed("local_item", "item"), ["src_file", "item"]).withColumnRenamed("src_file", "doc_id")
    out = wrap.collate_pieces(hyps, words="nbest_words", n_best=2)
    return format_rows(out, "json").select("doc_id", F.col("value").alias("line"))
