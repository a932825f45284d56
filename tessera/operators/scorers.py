"""Scorers as aggregates in a registry.

A scorer is three steps over DataFrames: ``rows`` turns segments into one row of
numbers each, ``merge`` are the aggregates that sum them (partial sums in the
tasks, one small row per test set shuffled), ``finish`` makes the metrics of the
sums.  Which set is scored by what, and with which arguments, is a table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import scoring

NO_SCORER = "no such scorer"
RESULT = "test_set string, scorer string, metric string, value double, error string"


@dataclass(frozen=True)
class Scorer:
    """``rows`` gets ``test_set, hyp, refs, query, args`` and returns ``test_set`` and
    columns of its own; ``merge`` and ``finish`` give columns over these."""
    name: str
    rows: Callable[[DataFrame], DataFrame]
    merge: Callable[[], list[Column]]
    finish: Callable[[], dict[str, Column]]


SCORERS: dict[str, Scorer] = {}


def register(scorer: Scorer) -> Scorer:
    if scorer.name in SCORERS:
        raise ValueError(f"scorer {scorer.name} is registered already")
    SCORERS[scorer.name] = scorer
    return scorer


def _arg(name: str) -> Column:
    return F.try_element_at(F.col("args"), F.lit(name))


def _bleu_rows(segments: DataFrame) -> DataFrame:
    low = F.coalesce(_arg("lowercase") == "true", F.lit(False))
    refs = F.when(low, F.transform("refs", F.lower)).otherwise(F.col("refs"))
    return scoring.bleu_rows(segments, ["test_set"], F.when(low, F.lower("hyp")).otherwise(F.col("hyp")), refs)


#: A8; argument ``lowercase=true`` compares lower-cased texts.
register(Scorer("SacrebleuScorer", _bleu_rows, scoring.bleu_merge, lambda: {"bleu": scoring.bleu_finish()["bleu"]}))

#: A9; a set without any term has 0 of 0 and no score.
register(Scorer("QueryScorer", lambda s: scoring.query_rows(s, ["test_set"], F.col("hyp"), F.col("query")), scoring.query_merge,
                lambda: {"inserted": F.coalesce("inserted", F.lit(0)), "expected": F.coalesce("expected", F.lit(0)),
                         "score": F.col("score")}))


def score(segments: DataFrame, asked: DataFrame, scorers: Mapping[str, Scorer] | None = None) -> DataFrame:
    """``test_set, scorer, metric, value, error`` of every set and scorer asked for.

    ``segments``: ``test_set, hyp, refs ARRAY<STRING>, query`` (null without one);
    ``asked``: ``test_set, scorer, args MAP<STRING,STRING>``, of repeated pairs one.
    A null hypothesis counts as empty, an unknown scorer is one row with an error,
    and a set without segments has the metrics of no segments.  One pass over the
    segments for each scorer that is asked for; sets it is not asked for are
    dropped before anything is computed."""
    scorers = SCORERS if scorers is None else scorers
    asked = asked.dropDuplicates(["test_set", "scorer"])
    segments = segments.withColumn("hyp", F.coalesce("hyp", F.lit("")))
    parts = [asked.where(F.col("scorer").isNull() | ~F.col("scorer").isin(*scorers) if scorers else F.lit(True)).select(
        "test_set", "scorer", F.lit(None).cast("string").alias("metric"), F.lit(None).cast("double").alias("value"),
        F.lit(NO_SCORER).alias("error"))]
    for name, s in scorers.items():
        mine = asked.where(F.col("scorer") == name).select("test_set", "args")
        merged = s.rows(segments.join(mine, "test_set")).groupBy("test_set").agg(*s.merge())
        metrics = F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("value")) for m, c in s.finish().items()])
        parts.append(mine.select("test_set").join(merged, "test_set", "left")
                     .select("test_set", F.lit(name).alias("scorer"), F.explode(metrics).alias("_m"))
                     .select("test_set", "scorer", "_m.metric", "_m.value", F.lit(None).cast("string").alias("error")))
    return reduce(DataFrame.unionByName, parts)
