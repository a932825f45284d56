"""Case model and truecasing of a corpus.

The reference runs an external truecaser per sentence with a model file it
does not ship.  Here the model is an aggregation over the corpus itself and
truecasing is a join of the corpus's distinct tokens with the model, and of the
few that it changes with the lines that have them:

* model: over tokens that do not start a sentence, count every surface form
  per lower-cased form; the best form is the most frequent (ties: the
  smallest string); ``forms`` lists every form seen.
* apply: a sentence-initial token takes the best form of its lower-cased
  form; any other token stays if it is a known form, else takes the best form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.session import materialize

# Fixed value: a token ending in one of these ends a sentence.
SENTENCE_END = r"[.!?:]$"


def token_table(lines: DataFrame, keys=("doc_id", "line_no"), text: str = "text") -> DataFrame:
    """``keys…, pos, token, initial`` — one row per token (blank lines keep
    one row with a null token so they survive regrouping)."""
    keys = list(keys)
    tok = lines.select(*keys, T.tokens(F.col(text)).alias("_tok"))
    flags = F.transform("_tok", lambda t, i: F.struct(t.alias("token"), (
        (i == 0) | F.coalesce(F.get(F.col("_tok"), i - 1).rlike(SENTENCE_END), F.lit(False))).alias("initial")))
    return (tok.select(*keys, F.posexplode_outer(flags).alias("pos", "_t"))
               .select(*keys, "pos", F.col("_t.token").alias("token"), F.col("_t.initial").alias("initial")))


def case_model(tokens: DataFrame) -> DataFrame:
    """``lc, best, n_best, n_total, forms`` from non-initial tokens."""
    forms = (tokens.filter(F.col("token").isNotNull() & ~F.col("initial"))
             .groupBy(F.lower("token").alias("lc"), F.col("token").alias("surface")).agg(F.count("*").alias("n")))
    w = Window.partitionBy("lc").orderBy(F.col("n").desc(), F.col("surface"))
    ranked = forms.withColumn("_r", F.row_number().over(w))
    return ranked.groupBy("lc").agg(
        F.max_by("surface", F.when(F.col("_r") == 1, F.lit(1)).otherwise(F.lit(0))).alias("best"),
        F.max(F.when(F.col("_r") == 1, F.col("n"))).alias("n_best"),
        F.sum("n").alias("n_total"),
        F.sort_array(F.collect_list("surface")).alias("forms"))


def truecase(tokens: DataFrame, model: DataFrame, keys=("doc_id", "line_no")) -> DataFrame:
    """Truecased lines ``keys…, text`` of a token table."""
    lines = tokens.groupBy(*keys).agg(F.collect_list(F.struct("pos", "token", "initial")).alias("_x"))
    return _cased(lines, "_x", lambda x: x, model, keys)


def truecase_lines(lines: DataFrame, model: DataFrame, keys=("doc_id", "line_no"), text: str = "text") -> DataFrame:
    """:func:`truecase` of the lines themselves: their text moves once, as it is."""
    return _cased(lines.select(*keys, F.col(text).alias("_x")), "_x", _flagged, model, keys)


def _flagged(text: Column) -> Column:
    """The tokens of a text as :func:`token_table` has them, one array a line."""
    tok = T.tokens(text)
    both = F.arrays_zip(tok.alias("token"), F.concat(F.array(F.lit(None).cast("string")), tok).alias("before"))
    return F.transform(both, lambda b, i: F.struct(i.alias("pos"), b["token"].alias("token"), (
        (i == 0) | F.coalesce(b["before"].rlike(SENTENCE_END), F.lit(False))).alias("initial")))


def _cased(lines: DataFrame, given: str, flagged, model: DataFrame, keys) -> DataFrame:
    """Lines ``keys…, given`` with the tokens ``flagged(given)`` as truecased texts.

    Only distinct tokens meet the model, which is written first: AQE then knows its size,
    broadcasts it if that is small and else splits a hot word.  Those that it changes (mostly some
    that start sentences) are written, too, and join the lines' distinct tokens; without one
    that is not initial, only the initial tokens of a line.  A line and its changes then meet by key.
    (Outer explodes: before a plain one Spark filters out empty arrays, which splits each line again.)"""
    keys = list(keys)
    m = materialize(model.select("lc", "best", "forms"))
    held = F.filter(flagged(F.col(given)), lambda t: t["token"].isNotNull())
    seen = lines.select(*keys, F.transform(held, lambda t: F.struct(t["initial"].alias("initial"), t["token"].alias("token"))).alias("_s"))
    types = seen.select(F.explode_outer("_s").alias("_s")).select("_s.*").distinct().withColumn("lc", F.lower("token"))
    same = ~F.col("initial") & F.coalesce(F.array_contains("forms", F.col("token")), F.lit(False))
    changes = materialize(types.join(m, "lc").where(~same & (F.col("best") != F.col("token"))).select("initial", "token", "best"))
    if changes.where("not initial").isEmpty():
        seen = seen.withColumn("_s", F.filter("_s", lambda t: t["initial"]))
    changed = (seen.select(*keys, F.explode_outer(F.array_distinct("_s")).alias("_s")).select(*keys, "_s.*").join(changes, ["initial", "token"])
               .select(*keys, F.lit(None).cast(lines.schema[given].dataType).alias(given), F.struct("initial", "token", "best").alias("_c")))
    both = lines.select(*keys, given, F.lit(None).cast(changed.schema["_c"].dataType).alias("_c")).unionByName(changed).repartition(*keys)
    per_line = both.groupBy(*keys).agg(F.collect_list(given).alias("_x"), F.collect_list("_c").alias("_c"))

    def found(initial):
        own = F.filter("_c", lambda c: c["initial"] == F.lit(initial))
        return F.map_from_entries(F.array_distinct(F.transform(own, lambda c: F.struct(c["token"], c["best"]))))

    per_line = per_line.select(*keys, F.flatten(F.transform("_x", flagged)).alias("_t"), found(True).alias("_first"), found(False).alias("_later"))
    out = lambda t: F.coalesce(F.when(t["initial"], F.try_element_at("_first", t["token"])).otherwise(F.try_element_at("_later", t["token"])), t["token"])
    placed = F.transform(F.filter("_t", lambda t: t["token"].isNotNull()), lambda t: F.struct(t["pos"].alias("pos"), out(t).alias("t")))
    return per_line.select(*keys, F.array_join(F.transform(F.sort_array(placed), lambda p: p["t"]), " ").alias("text"))
