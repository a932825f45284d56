"""Subword queries: merges, segmentation, vocabulary filter, unigram model.

The oracle learns the merges one at a time, with a full recount before each.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import bpe, unigram
from tessera.plans.corpus import lines_of
from tessera.plans.registry import register
from tessera.plans.sqlparts import LINES, with_

MERGES = 20
VOCAB_MIN = 200      # occurrences of a unit that the vocabulary keeps
SPLITS = 5           # passes of the oracle; 20 merges nest no deeper
PIECES, SEED = 1000, 4000


def merges_sql(n: int = MERGES) -> str:
    """CTEs: ``s{n}(word, n, sym)`` after ``n`` merges and ``merges(rank, left, right, cnt)``."""
    old, new = "chr(1) || l || chr(2) || chr(1) || r || chr(2)", "chr(1) || l || r || chr(2)"
    parts = [LINES, r"""
words AS (SELECT token AS word, count(*) AS n FROM (
  SELECT unnest(regexp_split_to_array(trim(text), '\s+')) AS token FROM lines WHERE trim(text) <> '') GROUP BY 1),
s0 AS MATERIALIZED (SELECT word, n, chr(1) || array_to_string(regexp_extract_all(word, '(?s).'), chr(2) || chr(1)) || '</w>' || chr(2) AS sym
  FROM words)"""]
    for k in range(n):
        parts.append(f"""
a{k} AS (SELECT n, string_split(substr(sym, 2, length(sym) - 2), chr(2) || chr(1)) AS a FROM s{k}),
q{k} AS (SELECT n, a, unnest(range(1, len(a))) AS i FROM a{k}),
b{k} AS MATERIALIZED (SELECT a[i] AS l, a[i + 1] AS r, sum(n) AS cnt FROM q{k} GROUP BY 1, 2 ORDER BY cnt DESC, l, r LIMIT 1),
s{k + 1} AS MATERIALIZED (SELECT word, n, replace(sym, (SELECT {old} FROM b{k}), (SELECT {new} FROM b{k})) AS sym FROM s{k})""")
    parts.append("merges AS (" + " UNION ALL ".join(f'SELECT {k} AS rank, l AS "left", r AS "right", CAST(cnt AS BIGINT) AS cnt FROM b{k}'
                                                    for k in range(n)) + ")")
    return with_(*parts)


#: units of each word in order: ``u0(word, n, path, unit, final)``, the end mark removed
UNITS_SQL = merges_sql() + f"""
, arr AS (SELECT word, n, string_split(substr(sym, 2, length(sym) - 2), chr(2) || chr(1)) AS a FROM s{MERGES}),
 at0 AS (SELECT word, n, a, unnest(range(1, len(a) + 1)) AS i FROM arr),
 u0 AS (SELECT word, n, printf('%06d', i) AS path, CASE WHEN i = len(a) THEN a[i][1:-5] ELSE a[i] END AS unit, i = len(a) AS final FROM at0)"""


def lines_sql(units: str) -> str:
    """Lines of the corpus with each word written as its units of a CTE."""
    return f"""
, spelled AS (SELECT word, string_agg(unit, '@@ ' ORDER BY path) AS enc FROM {units} GROUP BY word),
 tok AS (SELECT doc_id, line_no, CASE WHEN trim(text) = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(trim(text), '\\s+') END AS t FROM lines),
 pos AS (SELECT doc_id, line_no, unnest(range(1, len(t) + 1)) AS i, unnest(t) AS word FROM tok),
 enc AS (SELECT doc_id, line_no, string_agg(enc, ' ' ORDER BY i) AS text FROM pos JOIN spelled USING (word) GROUP BY 1, 2)
SELECT l.doc_id, l.line_no, coalesce(e.text, '') AS text FROM lines l LEFT JOIN enc e USING (doc_id, line_no)"""


def vocab_sql() -> str:
    """Units below the threshold taken apart, one level a pass: ``u{SPLITS}``."""
    out = UNITS_SQL + f"""
, vocab AS (SELECT unit || CASE WHEN final THEN '' ELSE '@@' END AS token FROM u0 GROUP BY 1 HAVING sum(n) >= {VOCAB_MIN}),
 made AS (SELECT "left" || "right" AS whole, arg_min("left", rank) AS l, arg_min("right", rank) AS r FROM merges GROUP BY 1)"""
    for k in range(SPLITS):
        out += f"""
, m{k} AS (SELECT u.*, CASE WHEN v.token IS NULL THEN m.l END AS l, m.r FROM u{k} u
   LEFT JOIN vocab v ON v.token = u.unit || CASE WHEN u.final THEN '' ELSE '@@' END
   LEFT JOIN made m ON m.whole = u.unit || CASE WHEN u.final THEN '</w>' ELSE '' END),
 u{k + 1} AS (SELECT word, n, path, unit, final FROM m{k} WHERE l IS NULL
   UNION ALL SELECT word, n, path || '0', l, false FROM m{k} WHERE l IS NOT NULL
   UNION ALL SELECT word, n, path || '1', CASE WHEN final THEN r[1:-5] ELSE r END, final FROM m{k} WHERE l IS NOT NULL)"""
    return out + lines_sql(f"u{SPLITS}")


@register("bpe_merges", merges_sql() + """
SELECT CAST(rank AS INTEGER) AS rank, "left", "right", cnt FROM merges""")
def bpe_merges(spark, sf_dir):
    """The first 20 BPE merges of the documents vocabulary."""
    return bpe.learn_merges(lines_of(spark, sf_dir), MERGES)


@register("bpe_segment_join", UNITS_SQL + lines_sql("u0"))
def bpe_segment_join(spark, sf_dir):
    """every line subword-encoded with the learned merges, unit by unit (the
    words of a line are segmented in its row; no join, whatever the name says)."""
    lines = lines_of(spark, sf_dir)
    return bpe.encode_corpus(lines, bpe.learn_merges(lines, MERGES))


@register("bpe_vocab_segment", vocab_sql())
def bpe_vocab_segment(spark, sf_dir):
    """The corpus encoded, its units counted into a vocabulary, and encoded
    again with only units that occur 200 times; rarer ones are taken apart."""
    lines = lines_of(spark, sf_dir)
    merges = bpe.learn_merges(lines, MERGES)
    vocab = bpe.unit_counts(bpe.encode_corpus(lines, merges))
    return bpe.encode_corpus(lines, merges, vocab=vocab, threshold=VOCAB_MIN)


ROUNDTRIP = with_(LINES) + r"""
SELECT doc_id, line_no, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM lines"""


@register("bpe_learned_roundtrip", ROUNDTRIP)
def bpe_learned_roundtrip(spark, sf_dir):
    """F34 then F33: encode with the learned merges, decode, get the line back."""
    lines = lines_of(spark, sf_dir)
    enc = bpe.encode_corpus(lines, bpe.learn_merges(lines, MERGES))
    return enc.select("doc_id", "line_no", T.strip(T.bpe_decode(F.col("text"))).alias("text"))


@register("spm_learned_roundtrip", ROUNDTRIP)
def spm_learned_roundtrip(spark, sf_dir):
    """F32 on merges written with word-start marks: decoded lines are the lines."""
    lines = lines_of(spark, sf_dir)
    enc = bpe.encode_corpus(lines, bpe.learn_merges(lines, MERGES), style="spm")
    return enc.select("doc_id", "line_no", T.spm_decode(F.col("text")).alias("text"))


@register("spm_unigram_segment")
def spm_unigram_segment(spark, sf_dir):
    """F35 then F32: a unigram model of 1000 pieces learned from the documents, every
    line as its best pieces, and the pieces decoded (brute force in the tests)."""
    lines = lines_of(spark, sf_dir)
    enc = unigram.encode(lines, unigram.learn(lines, PIECES, seed_size=SEED))
    return enc.withColumn("decoded", T.spm_decode(F.col("text")))
