"""Scorers (A8-A10, F29, J5, J6, P9, P10, X3).

Corpus BLEU follows Papineni et al. (2002) with the conventions of Post
(2018): 13a tokenisation, clipped n-gram precision up to 4-grams, brevity
penalty against the closest reference length, exponential smoothing for
zero matches.  Clipping is per segment, so each segment's n-grams are counted
in its own row (an Arrow function over its tokens) and ten numbers a segment
are summed per set: no n-gram is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tessera.functions import text as T

MAX_ORDER = 4

# The 13a tokenisation rules (regex, replacement), in order.
TOK13A_ENTITIES = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
TOK13A_RULES = (
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)


def tokenize_13a(c: Column) -> Column:
    """13a tokenisation → whitespace tokens (array)."""
    s = F.replace(c, F.lit("<skipped>"), F.lit(""))
    s = F.replace(s, F.lit("-\n"), F.lit(""))
    s = F.replace(s, F.lit("\n"), F.lit(" "))
    for ent, ch in TOK13A_ENTITIES:
        s = F.replace(s, F.lit(ent), F.lit(ch))
    s = F.concat(F.lit(" "), s, F.lit(" "))
    for pat, rep in TOK13A_RULES:
        s = F.regexp_replace(s, pat, rep)
    return T.tokens(s)


def _tokens_once(segments: DataFrame, keys: list[str], cols: dict[str, str]) -> DataFrame:
    """13a tokens of every side, projected once (lambdas below only see columns)."""
    return segments.select(*keys, *[tokenize_13a(F.col(c)).alias(f"_t_{k}") for k, c in cols.items()])


def segment_counts(hyp: list[str], refs: list[list[str]]) -> list[int]:
    """Clipped matches of the orders 1-4, n-grams of the hypothesis of the
    orders 1-4, its length, and the closest reference length (ties: shorter)."""
    clipped, totals = [], []
    for n in range(1, MAX_ORDER + 1):
        def counts(tokens, n=n):
            return Counter(zip(*[tokens[i:] for i in range(n)]))
        mine = counts(hyp)
        bound = Counter()
        for ref in refs:
            bound |= counts(ref)
        clipped.append((mine & bound).total())
        totals.append(max(0, len(hyp) - n + 1))
    closest = min((abs(len(r) - len(hyp)), len(r)) for r in refs)[1]
    return [*clipped, *totals, len(hyp), closest]


@F.arrow_udf(ArrayType(LongType()))
def _segment_counts(hyps: pa.Array, refs: pa.Array) -> pa.Array:
    return pa.array([segment_counts(h or [], [r or [] for r in rs]) for h, rs in zip(hyps.to_pylist(), refs.to_pylist())],
                    pa.list_(pa.int64()))


def first_rank(hyps: DataFrame, rank: str = "rank") -> DataFrame:
    """Of n-best output only the best hypothesis of each line is scored."""
    return hyps.filter(F.col(rank) == 0).drop(rank)


def corpus_bleu(segments: DataFrame, group: Sequence[str], seg_key: Sequence[str], hyp: str = "hyp",
                refs: Sequence[str] = ("ref",)) -> DataFrame:
    """BLEU per ``group`` (e.g. test set) → ``group…, bleu, bp, sys_len, ref_len, p1..p4``."""
    group, seg_key = list(group), list(seg_key)
    keys = group + seg_key
    cols = {"h": hyp, **{f"r{i}": r for i, r in enumerate(refs)}}
    tok = _tokens_once(segments, keys, cols)
    refs_ = F.array(*[F.col(f"_t_r{i}") for i in range(len(refs))])
    counts = tok.select(*group, _segment_counts(F.col("_t_h"), refs_).alias("_c"))
    return counts.groupBy(*group).agg(*bleu_merge()).select(*group, *[c.alias(m) for m, c in bleu_finish().items()])


def bleu_rows(segments: DataFrame, keep: Sequence[str], hyp: Column, refs: Column) -> DataFrame:
    """``keep…, _c``: a segment's ten numbers; ``refs`` is an array of any length."""
    tok = segments.select(*keep, tokenize_13a(hyp).alias("_h"), refs.alias("_refs"))
    tok = tok.select(*keep, "_h", F.transform("_refs", tokenize_13a).alias("_r"))
    return tok.select(*keep, _segment_counts(F.col("_h"), F.col("_r")).alias("_c"))


def bleu_merge() -> list[Column]:
    """Sums of the segments' numbers."""
    names = [*(f"{n}_c" for n in range(1, MAX_ORDER + 1)), *(f"{n}_t" for n in range(1, MAX_ORDER + 1)), "sys_len", "ref_len"]
    return [F.sum(F.get("_c", i)).alias(name) for i, name in enumerate(names)]


def bleu_finish() -> dict[str, Column]:
    """BLEU and its parts from the sums."""
    cols_n = {n: (F.coalesce(F.col(f"{n}_c"), F.lit(0)), F.coalesce(F.col(f"{n}_t"), F.lit(0)))
              for n in range(1, MAX_ORDER + 1)}
    # exponential smoothing: the k-th order with zero matches gets 100 / (2^k * total)
    zeros = F.lit(0)
    prec = {}
    for n in range(1, MAX_ORDER + 1):
        c, t = cols_n[n]
        zeros = zeros + (c == 0).cast("int")
        prec[n] = F.when(t == 0, F.lit(0.0)).when(c == 0, F.lit(100.0) / (F.pow(F.lit(2.0), zeros) * t)) \
                   .otherwise(F.lit(100.0) * c / t)
    log_sum = sum((F.log(F.greatest(prec[n], F.lit(1e-300))) for n in range(1, MAX_ORDER + 1)), F.lit(0.0))
    any_zero = F.greatest(*[(prec[n] <= 0).cast("int") for n in prec]) > 0
    bp = F.when(F.col("sys_len") >= F.col("ref_len"), F.lit(1.0)).when(F.col("sys_len") == 0, F.lit(0.0)) \
          .otherwise(F.exp(F.lit(1.0) - F.col("ref_len") / F.col("sys_len")))
    bleu = F.when(any_zero, F.lit(0.0)).otherwise(bp * F.exp(log_sum / MAX_ORDER))
    return {"bleu": F.round(bleu, 6), "bp": F.round(bp, 6), "sys_len": F.col("sys_len").cast("long"),
            "ref_len": F.col("ref_len").cast("long"), **{f"p{n}": F.round(prec[n], 6) for n in prec}}


def query_term_scores(pred: DataFrame, group: Sequence[str], hyp: str = "hyp", query: str = "query") -> DataFrame:
    """Inserted and expected query terms, mean per-sentence metric.

    A sentence with no terms is skipped; the metric is NULL when no sentence
    has terms.  Counting is Python ``str.count`` (non-overlapping, literal).
    """
    group = list(group)
    rows = query_rows(pred, group, F.col(hyp), F.col(query))
    return rows.groupBy(*group).agg(*query_merge())


def query_rows(pred: DataFrame, keep: Sequence[str], hyp: Column, query: Column) -> DataFrame:
    """``keep…, _exp, _ins`` of every sentence that has terms."""
    q = T.strip(query)
    rows = pred.filter(q != "").select(*keep, T.strip(hyp).alias("_h"), T.query_terms(q).alias("_terms"))
    return rows.select(*keep, F.size("_terms").alias("_exp"),
                       F.aggregate(F.col("_terms"), F.lit(0).cast("long"),
                                   lambda acc, term: acc + T.count_occurrences(F.col("_h"), term)).alias("_ins"))


def query_merge() -> list[Column]:
    return [F.sum("_ins").cast("long").alias("inserted"), F.sum("_exp").cast("long").alias("expected"),
            F.round(F.avg(F.lit(1.0) - F.abs(F.col("_ins") - F.col("_exp")) / F.col("_exp")), 6).alias("score")]
