"""The request stream with one text processor and decoder per system.

A request stays one row per line from the message to the response: its pieces,
hypotheses and tags are arrays of that row, so the query has no state and no
shuffle.  Which processor a row takes is a ``when`` over the systems, a fixed
registry; the decoder runs over Arrow batches and gets each system's pieces in
one call.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as TT

from tessera.functions import text as T
from tessera.functions.processors import TextProcessor
from tessera.operators import placeholders
from tessera.operators.wrap import MAX_SENTENCE_LENGTH

BAD_QUERY = "number of queries does not match number of lines"
UNKNOWN = "no system translates this pair of languages"
IGNORED_QUERY = "query guided translation is not supported by this system, query ignored"

Decode = Callable[[str, list, int], list]


@dataclass(frozen=True)
class System:
    """How the requests of one language pair are translated."""
    processor: TextProcessor = field(default_factory=TextProcessor)
    n_best: int = 1
    words: bool = False
    extract_tags: bool = False
    takes_query: bool = False


def _choose(of: Column, options: Mapping[str, Column], otherwise: Column) -> Column:
    """The option named by ``of``."""
    out = None
    for name, value in options.items():
        out = F.when(of == name, value) if out is None else out.when(of == name, value)
    return otherwise if out is None else out.otherwise(otherwise)


def _flag(system: Column, systems: Mapping[str, System], attr: str) -> Column:
    names = [n for n, s in systems.items() if getattr(s, attr)]
    return system.isin(*names) if names else F.lit(False)


def _each_piece(pieces: str, processor: TextProcessor) -> Column:
    return F.transform(pieces, lambda p: T.strip(processor.pre_piece(p)))


def request_lines(requests: DataFrame, systems: Mapping[str, System]) -> DataFrame:
    """``conv_id, turn, system, id, line, query, warning, error`` of every message.

    A system's name is ``<src>-<tgt>``.  A message whose query lines differ in
    number from its text lines, or whose pair no system knows, is one error row
    with id -1.  A query for a system that takes none is ignored with a warning."""
    pair = F.concat_ws("-", "src_lang", "tgt_lang")
    known = pair.isin(*systems) if systems else F.lit(False)
    takes = _flag(pair, systems, "takes_query")
    m = requests.select("conv_id", "turn", pair.alias("system"), T.split_message(F.coalesce("text", F.lit(""))).alias("lines"),
                        F.when(takes & F.col("query").isNotNull(), F.split("query", "\n", -1)).alias("qs"),
                        F.when(known & ~takes & F.col("query").isNotNull(), F.lit(IGNORED_QUERY)).alias("warning"))
    error = F.when(~F.col("system").isin(*systems) if systems else F.lit(True), F.lit(UNKNOWN)).when(
        F.size(F.coalesce("qs", "lines")) != F.size("lines"), F.lit(BAD_QUERY))
    m = m.withColumn("error", error)
    whole = F.array(F.struct(F.lit(-1).cast("long").alias("id"), F.lit(None).cast("string").alias("line"),
                             F.lit(None).cast("string").alias("query")))
    each = F.transform("lines", lambda l, i: F.struct(i.cast("long").alias("id"), l.alias("line"), F.get("qs", i).alias("query")))
    return (m.withColumn("_at", F.explode(F.when(F.col("error").isNotNull(), whole).otherwise(each)))
             .select("conv_id", "turn", "system", "_at.*", "warning", "error"))


def request_pieces(lines: DataFrame, systems: Mapping[str, System], max_length: int = MAX_SENTENCE_LENGTH) -> DataFrame:
    """Adds ``is_empty, tags, pieces``: each line with its tags taken out (where its
    system does so), its query appended, pre-processed by its system's processor
    and wrapped.  Error rows have no pieces."""
    system = F.col("system")
    df = lines.withColumn("is_empty", T.is_blank("line"))
    df = placeholders.extract_placeholders(df, "line", "_out", "tags")
    tagged = _flag(system, systems, "extract_tags")
    df = (df.withColumn("tags", F.when(tagged, F.col("tags")).otherwise(F.array().cast(placeholders.TAGS_TYPE)))
            .withColumn("_line", F.when(tagged, F.col("_out")).otherwise(F.col("line"))))
    # a query reaches the processor behind a tab; a processor for queries puts it into its own form
    df = df.withColumn("_line", T.strip(F.when(F.col("query").isNull(), F.col("_line")).otherwise(
        F.concat_ws("\t", "_line", "query"))))
    ready = _choose(system, {n: s.processor.pre(F.col("_line")) for n, s in systems.items()}, F.col("_line"))
    df = df.withColumn("_line", ready).withColumn("_tok", T.tokens("_line")).withColumn("_n", F.size("_tok"))
    m, tok = F.lit(max_length), F.col("_tok")
    cut = F.when(F.col("_n") > m, F.transform(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / m).cast("int")),
                                              lambda i: F.array_join(F.slice(tok, i * m + 1, m), " "))).otherwise(F.array("_line"))
    df = df.withColumn("_cut", cut)
    after = _choose(system, {n: _each_piece("_cut", s.processor) for n, s in systems.items()}, F.col("_cut"))
    none = F.array().cast("array<string>")
    return (df.withColumn("pieces", F.when(F.col("error").isNull(), after).otherwise(none))
              .drop("_out", "_line", "_tok", "_n", "_cut"))


_MAPS = TT.ArrayType(TT.MapType(TT.StringType(), TT.StringType()))


def decode_pieces(lines: DataFrame, systems: Mapping[str, System], factory: Callable[[], Decode]) -> DataFrame:
    """Replaces ``pieces`` by ``hyps``: of every piece its hypotheses, best first, each
    ``(text, words)``.

    ``factory()`` is called once a task and gives ``decode(system, texts, n_best)``,
    which returns a list of hypotheses per text; a hypothesis is its text or a pair
    of its text and its positions (dicts of alternative and score).  A batch's pieces
    of one system go to it in one call."""
    import pandas as pd

    n_best = {n: s.n_best for n, s in systems.items()}
    hyp = TT.StructType([TT.StructField("t", TT.StringType()), TT.StructField("w", _MAPS)])
    schema = TT.StructType([f for f in lines.schema.fields if f.name != "pieces"]
                           + [TT.StructField("hyps", TT.ArrayType(TT.ArrayType(hyp)))])
    # tags are structs, which pandas would turn into rows and back; they cross as JSON
    tags = lines.schema["tags"].dataType
    slim = lines.withColumn("tags", F.to_json("tags"))
    names = [f.name for f in schema.fields]
    sent = TT.StructType([TT.StructField(f.name, TT.StringType() if f.name == "tags" else f.dataType) for f in schema.fields])

    def form(h):
        text, words = h if isinstance(h, tuple) else (h, [])
        return {"t": text, "w": [{str(a): str(s) for a, s in dict(p).items()} for p in words]}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = factory()
        for pdf in batches:
            hyps = [[] for _ in range(len(pdf))]
            for name in pdf["system"].unique():
                if name not in n_best:
                    continue
                at = [(i, p) for i, (s, ps) in enumerate(zip(pdf["system"], pdf["pieces"])) if s == name for p in ps]
                if not at:
                    continue
                for (i, _), cand in zip(at, decode(name, [p for _, p in at], n_best[name]), strict=True):
                    hyps[i].append([form(h) for h in list(cand)[:n_best[name]]])
            yield pdf.drop(columns="pieces").assign(hyps=hyps)[names]

    return slim.mapInPandas(run, sent).withColumn("tags", F.from_json("tags", tags))


def responses(decoded: DataFrame, systems: Mapping[str, System]) -> DataFrame:
    """``conv_id, turn, id, rank, translation, nbest_words, warning, error``: one row per
    line and rank, one per error.

    A rank that some piece lacks is left out; an empty line has all ranks of its
    system, blank, whatever the decoder made of it."""
    system = F.col("system")
    ranks = _choose(system, {n: F.lit(s.n_best) for n, s in systems.items()}, F.lit(1))
    # every piece has the ranks from 0 on, so the smallest number is what all share
    shared = F.when(F.col("is_empty") | F.col("error").isNotNull(), ranks).otherwise(
        F.array_min(F.transform("hyps", lambda h: F.size(h))))
    df = decoded.withColumn("_k", shared).filter((F.col("_k") > 0) | F.col("error").isNotNull())
    last = F.when(F.col("error").isNotNull(), F.lit(0)).otherwise(F.col("_k") - 1)
    df = df.withColumn("rank", F.explode(F.sequence(F.lit(0), last)))
    rank = F.col("rank")
    df = df.withColumn("_joined", F.array_join(F.transform("hyps", lambda h: T.strip(F.get(h, rank)["t"])), " "))
    post = _choose(system, {n: T.strip(s.processor.post(F.col("_joined"))) for n, s in systems.items()}, F.col("_joined"))
    df = df.withColumn("_post", post)
    text = F.when(F.col("error").isNotNull(), F.lit(None)).when(F.col("is_empty"), F.lit("")).otherwise(
        placeholders.reinsert_column(F.col("_post"), F.col("tags")))
    none = F.array().cast(_MAPS)
    words = F.when(F.col("error").isNull() & _flag(system, systems, "words"), F.when(F.col("is_empty"), none).otherwise(
        F.flatten(F.transform("hyps", lambda h: F.get(h, rank)["w"]))))
    return df.select("conv_id", "turn", "id", F.col("rank").cast("int").alias("rank"), text.alias("translation"),
                     words.alias("nbest_words"), "warning", "error")


def serve(requests: DataFrame, systems: Mapping[str, System], factory: Callable[[], Decode],
          max_length: int = MAX_SENTENCE_LENGTH) -> DataFrame:
    """Requests (``jobs.REQUEST_SCHEMA``, a stream or a table) → :func:`responses`.

    Null or blank texts are one empty line.  Processors that truecase or segment
    need a corpus model joined by word, which a row of its own cannot have: they
    raise ValueError here and run in ``operators.translate`` (or in the decoder)."""
    for name, s in systems.items():
        if s.processor.truecases or s.processor.subwords:
            raise ValueError(f"system {name}: processor {s.processor.name} needs corpus models")
        if s.n_best < 1:
            raise ValueError(f"system {name}: n_best must be at least 1")
    pieces = request_pieces(request_lines(requests, systems), systems, max_length)
    return responses(decode_pieces(pieces, systems, factory), systems)
