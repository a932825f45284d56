"""The pluggable batch-inference hook.

The translating model is not part of the engine.  A decoder is any function
``list[str] -> list[list[str]]`` (n hypotheses per input, best first); it is
applied to Arrow batches with ``mapInPandas`` so the model is loaded once per
task and fed batches of ``spark.sql.execution.arrow.maxRecordsPerBatch``
pieces (the reference's mini-batch).  ``echo_decode`` is the JVM-side
stand-in used by tests and benchmarks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T

Decoder = Callable[[list], list]


def echo_decode(pieces: DataFrame, n_best: int = 1, text: str = "text", words: bool = False) -> DataFrame:
    """Test decoder: rank 0 is the input, higher ranks its lower-cased form.

    With ``words`` every position offers its token and the token's lower-cased
    form (one entry when they are equal), then the end token."""
    ranks = F.explode(F.sequence(F.lit(0), F.lit(n_best - 1))).alias("rank")
    out = (pieces.select("*", ranks)
           .withColumn("translation", F.when(F.col("rank") == 0, F.col(text)).otherwise(F.lower(text)))
           .drop(text))
    if not words:
        return out
    position = lambda w: F.when(w == F.lower(w), F.create_map(w, F.lit("-1.5"))).otherwise(
        F.create_map(w, F.lit("-0.5"), F.lower(w), F.lit("-1.5")))
    out = out.withColumn("_tok", T.tokens("translation"))
    return out.withColumn("nbest_words", F.concat(F.transform("_tok", position),
                                                  F.array(F.create_map(F.lit("</s>"), F.lit("-0.1"))))).drop("_tok")


def batch_decode(pieces: DataFrame, decoder_factory: Callable[[], Decoder], n_best: int = 1,
                 text: str = "text", keys: Sequence[str] | None = None, extras: Sequence[str] = (),
                 words: bool = False) -> DataFrame:
    """Run ``decoder_factory()`` once per task over Arrow batches of pieces.

    ``extras`` names columns of further sources; the decoder then gets a list of
    each after the list of texts.  With ``words`` a hypothesis is a pair of its text
    and its positions, each a dict or a list of (alternative, score) pairs (a
    repeated alternative keeps its last score).

    Output: the input columns minus ``text`` plus ``rank INT, translation`` and,
    with ``words``, ``nbest_words ARRAY<MAP<STRING,STRING>>``.
    Only ``keys`` and ``text`` cross into Python; the rest is joined back by
    key, so wide rows are not serialised to the Python worker.
    """
    import pandas as pd

    keys = list(keys or [c for c in pieces.columns if c != text])
    extras = list(extras)
    slim = pieces.select(*keys, text, *extras)
    from pyspark.sql.types import ArrayType, IntegerType, MapType, StringType
    out_schema = slim.drop(text, *extras).schema.add("rank", IntegerType()).add("translation", StringType())
    if words:
        out_schema = out_schema.add("nbest_words", ArrayType(MapType(StringType(), StringType())))

    def run(batches):
        decode = decoder_factory()
        for pdf in batches:
            hyps = decode(pdf[text].tolist(), *[pdf[c].tolist() for c in extras])
            rows = []
            for i, cand in enumerate(hyps):
                for r, h in enumerate(list(cand)[:n_best] if n_best else cand):
                    rows.append((i, r, h))
            idx = pd.DataFrame(rows, columns=["_i", "rank", "translation"])
            base = pdf.drop(columns=[text, *extras]).reset_index(drop=True)
            res = base.iloc[idx["_i"].to_numpy()].reset_index(drop=True)
            res["rank"] = idx["rank"].astype("int32").to_numpy()
            if words:
                res["translation"] = [h for h, _ in idx["translation"]]
                res["nbest_words"] = [[{str(a): str(s) for a, s in dict(p).items()} for p in w] for _, w in idx["translation"]]
            else:
                res["translation"] = idx["translation"].to_numpy()
            yield res

    decoded = slim.mapInPandas(run, out_schema)
    rest = [c for c in pieces.columns if c not in keys and c != text and c not in extras]
    return decoded.join(pieces.select(*keys, *rest), keys) if rest else decoded
