"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed per cell (source, language, topic).  Raking scales the
cell weights to each target marginal in turn until all of them hold.  A cell's
rate is its raked weight times a token budget over its tokens: each document of
the cell is taken ``floor(rate)`` times and once more with the probability that
is left.  So the expected tokens of all copies are the budget (by default the
input's tokens) and have the target marginals, and a small cell is repeated
instead of shrinking every other one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import drop_staged, staged


@dataclass(frozen=True)
class Marginal:
    """Target shares of one dimension.

    A listed value gets its share of ``shares``; all others divide what is
    left in proportion to ``tokens ** exponent`` (1 keeps the natural shares,
    0 makes them equal).
    """

    name: str
    exponent: float = 1.0
    shares: dict[str, float] = field(default_factory=dict)


#: Marginals of the registered query and of the pipeline.
MARGINALS = (Marginal("source", 0.7), Marginal("lang", 0.8), Marginal("topic", 0.9))
SWEEPS_A_JOB = 4
DIGITS = 9


def tokens_of(text: Column) -> Column:
    """Words of a text; a text without any, or a null one, weighs one token."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t-\r]+")), F.lit(1)).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """Topic by form: tables, legal notices, then short, long and plain prose."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(F.contains(t, F.lit(" | ")), "table")
             .when(F.contains(t, F.lit("License")) | F.contains(t, F.lit("rights reserved")), "legal")
             .when(tokens < 64, "note").when(tokens >= 1024, "long").otherwise("prose"))


def targets(cells: DataFrame, m: Marginal) -> DataFrame:
    """Share of each value of one dimension: ``value, share``."""
    sums = cells.groupBy(F.col(m.name).alias("value")).agg(F.sum("tokens").alias("tokens"))
    given = F.lit(None).cast("double")
    for value, share in m.shares.items():
        given = F.when(F.col("value") == value, F.lit(float(share))).otherwise(given)
    part = F.pow(F.col("tokens").cast("double"), F.lit(float(m.exponent)))
    sums = sums.select("value", given.alias("given"), part.alias("part"))
    whole = sums.agg(F.coalesce(F.sum("given"), F.lit(0.0)).alias("g"),
                     F.sum(F.when(F.col("given").isNull(), F.col("part"))).alias("p"))
    rest = F.greatest(F.lit(0.0), 1 - F.col("g"))
    # scaled to sum 1 when the listed shares alone don't
    total = F.col("g") + F.when(F.col("p").isNull(), 0.0).otherwise(rest)
    return (sums.join(F.broadcast(whole))  # one row
                .select("value", (F.coalesce("given", F.col("part") / F.col("p") * rest) / total).alias("share")))


def rake(cells: DataFrame, marginals=MARGINALS, tolerance: float = 1e-10, max_sweeps: int = 60) -> DataFrame:
    """``cells(<dimensions>, tokens)`` with ``weight``, whose sums over each
    dimension have the target shares (total 1).

    Stops when no weight moves by more than ``tolerance`` of itself in a sweep,
    or after ``max_sweeps`` where the targets contradict each other (then the
    last marginal holds).  A job makes several sweeps; its result is
    written.  A window holds the cells of one value, which are few next to the
    documents: a row for each combination of values that occurs.
    """
    names = [m.name for m in marginals]
    fitted = cells.withColumn("weight", F.col("tokens").cast("double"))
    for m in marginals:
        share = targets(cells, m).select(F.col("value").alias("_v"), F.col("share").alias(f"_{m.name}"))
        fitted = fitted.join(share, F.col(m.name).eqNullSafe(F.col("_v"))).drop("_v")
    fitted = staged(fitted, "cells")
    for _ in range(0, max_sweeps, SWEEPS_A_JOB):
        before = fitted
        for step in range(SWEEPS_A_JOB):
            if step == SWEEPS_A_JOB - 1:
                fitted = fitted.withColumn("_before", F.col("weight"))
            for name in names:
                within = F.sum("weight").over(Window.partitionBy(name))
                fitted = fitted.withColumn("weight", F.col("weight") * F.col(f"_{name}") / within)
        fitted = staged(fitted, "cells")
        drop_staged(before)
        moved = fitted.agg(F.max(F.abs(F.col("weight") - F.col("_before")) / F.col("weight"))).first()[0]
        fitted = fitted.drop("_before")
        if moved is None or moved <= tolerance:
            break
    return fitted.select(*names, "tokens", "weight")


def hash_unit(key: Column, seed: int) -> Column:
    """A uniform number in [0, 1) fixed by the key and the seed."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def mixed(docs: DataFrame, columns: list[str], budget: int | None = None, marginals=MARGINALS, key: str = "doc_id",
          text: str = "text", topic=topic_of, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: ``doc`` (a struct of ``columns``), the dimensions,
    ``tokens, rate, copies``.

    ``topic`` is the name of a column that holds it, or a function of the text and
    its tokens (the default tells forms of text apart).  A row is read and its
    tokens are counted once; the rows are written, the cells aggregated from them
    before any shuffle, and each row gets its rate by a join on the cell.  Null
    sources, languages and topics are values of their own; a null or empty text
    weighs one token.  Repeated ids share one random number.  An empty table
    gives an empty result.
    """
    names = [m.name for m in marginals]
    value = {n: F.col(topic) if n == "topic" and isinstance(topic, str) else F.col(n) for n in names}
    rows = docs.select(F.struct(*[F.col(c) for c in columns]).alias("doc"), F.col(key).alias("_key"), tokens_of(F.col(text)).alias("_tokens"),
                       *[(F.col(text) if n == "topic" and callable(topic) else v).alias(f"_in{i}") for i, (n, v) in enumerate(value.items())])
    dims = [(topic(F.col(f"_in{i}"), F.col("_tokens")) if n == "topic" and callable(topic) else F.col(f"_in{i}")).alias(n) for i, n in enumerate(names)]
    rows = staged(rows.select("doc", F.col("_key").alias("_id"), *dims, F.col("_tokens").alias("tokens")), "celled")
    cells = staged(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "cells")
    total = budget if budget is not None else cells.agg(F.sum("tokens")).first()[0] or 0
    rated = rake(cells, marginals).select(
        *[F.col(n).alias(f"_{n}") for n in names],
        F.round(F.col("weight") * F.lit(float(total)) / F.col("tokens"), DIGITS).alias("rate"))
    joined = rows.join(rated, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names]).drop(*[f"_{n}" for n in names])
    whole = F.floor("rate")
    more = hash_unit(F.col("_id"), seed) < F.col("rate") - whole
    return joined.withColumn("copies", whole + more.cast("long")).drop("_id")


def sample_plan(docs: DataFrame, budget: int | None = None, marginals=MARGINALS, key: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, cell, tokens, rate, copies and whether it is in the sample; see :func:`mixed`."""
    plan = mixed(docs, [key], budget, marginals, key, **options)
    return plan.select(F.col("doc").getField(key).alias(key), *[m.name for m in marginals], "tokens", "rate", "copies",
                       (F.col("copies") > 0).alias("kept"))


def sample(docs: DataFrame, budget: int | None = None, marginals=MARGINALS, key: str = "doc_id", **options) -> DataFrame:
    """The sampled rows of ``docs``, each once, with all their columns and ``copies``, how
    often the sample holds it (a column of that name is replaced); see :func:`mixed`."""
    plan = mixed(docs, docs.columns, budget, marginals, key, **options).where("copies > 0")
    return plan.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() != "copies"], "copies")


def repeated(docs: DataFrame, budget: int | None = None, marginals=MARGINALS, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the sample holds it, all their columns; see :func:`mixed`."""
    plan = mixed(docs, docs.columns, budget, marginals, key, **options).where("copies > 0")
    return plan.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
