"""A catalogue of test sets: scan, translate and score all of them in one job.

The catalogue is configuration, one entry per set.  All files of all sets are one
scan by lines, joined with the catalogue by path; sets with one way of
pre-processing are translated together, and every set is scored by the scorers
its entry names.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.processors import Models, TextProcessor
from tessera.operators import scorers as S
from tessera.operators.scoring import first_rank
from tessera.operators.translate import translate_lines
from tessera.session import materialize
from tessera.sources.sinks import write_scores
from tessera.sources.tables import numbered_lines, one_slash, plain_name

MISSING = "file not found: "
UNEQUAL = "source and reference differ in their number of lines"


@dataclasses.dataclass(frozen=True)
class Entry:
    """One test set (D16): its source files (the first is translated, others are extra
    sources), its references, the arguments of each scorer, and how it is processed.

    ``preprocess=False`` is for files that are in the decoder's form already: they are
    wrapped and translated as they are, and only the output is processed.  The
    scorer argument ``query_fp`` names a file of query terms, line by line."""
    src: Sequence[str]
    ref: Sequence[str]
    scorers: Mapping[str, Mapping[str, str]] = dataclasses.field(default_factory=lambda: {"SacrebleuScorer": {}})
    processor: TextProcessor = dataclasses.field(default_factory=TextProcessor)
    preprocess: bool = True

    def files(self) -> list[tuple[str, int, str]]:
        """``role, position, path`` of every file."""
        queries = [a["query_fp"] for a in self.scorers.values() if "query_fp" in a]
        return [(role, i, p) for role, paths in (("src", self.src), ("ref", self.ref), ("query", queries[:1]))
                for i, p in enumerate(paths)]

    def effective(self) -> TextProcessor:
        if self.preprocess:
            return self.processor
        return TextProcessor(self.processor.name + " (post)", post=self.processor.post)


def _on_disk(spark: SparkSession, path: str) -> str | None:
    """The path as the scan names it, or None where there is no such file."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString() if fs.exists(p) else None


def missing_files(spark: SparkSession, catalogue: Mapping[str, Entry]) -> list[tuple[str, str]]:
    """``(set, error)`` of every file that is not there: one look per file of the catalogue."""
    return [(name, MISSING + path) for name, entry in catalogue.items() for _, _, path in entry.files()
            if _on_disk(spark, path) is None]


def read_sets(spark: SparkSession, catalogue: Mapping[str, Entry]) -> DataFrame:
    """``test_set, role, pos, line_no, text`` of all files of all sets, from one scan.

    A large file is many tasks.  The broadcast table has a row per file of the
    catalogue, however long the files are; a file of two sets is read once."""
    rows = [(name, role, pos, _on_disk(spark, path)) for name, entry in catalogue.items() for role, pos, path in entry.files()]
    files = spark.createDataFrame(rows, "test_set string, role string, pos int, file string")
    files = files.withColumn("file", one_slash(F.col("file")))
    raw = numbered_lines(spark.read.text(sorted({r[3] for r in rows}), lineSep="\n"))
    lines = raw.withColumn("file", plain_name(F.col("doc"))).join(F.broadcast(files), "file")
    return lines.select("test_set", "role", "pos", F.col("line_no").cast("long").alias("line_no"), "text")


def unequal_sets(lines: DataFrame, catalogue: Mapping[str, Entry]) -> DataFrame:
    """``test_set, error`` of the sets whose source and references are not equally long (a file without lines has 0)."""
    wanted = [(name, role, pos) for name, entry in catalogue.items() for role, pos, _ in entry.files()
              if (role, pos) == ("src", 0) or role == "ref"]
    files = lines.sparkSession.createDataFrame(wanted, "test_set string, role string, pos int")
    counts = lines.groupBy("test_set", "role", "pos").count()
    sizes = files.join(counts, ["test_set", "role", "pos"], "left").fillna(0, ["count"])
    return (sizes.groupBy("test_set").agg(F.min("count").alias("a"), F.max("count").alias("b")).where("a <> b")
            .select("test_set", F.lit(UNEQUAL).alias("error")))


def translate_sets(lines: DataFrame, catalogue: Mapping[str, Entry], decoder_factory: Callable | None = None,
                   models: Models | None = None) -> DataFrame:
    """``test_set, line_no, hyp``: the best hypothesis (P9) of every source line.

    Sets that share a processor, the preprocess flag and the number of sources are one
    job; there are as many jobs as ways of processing, not as sets."""
    ways: dict[tuple, list[str]] = {}
    for name, entry in catalogue.items():
        ways.setdefault((entry.effective(), len(entry.src)), []).append(name)
    keys = ("test_set", "line_no")
    done = []
    for (processor, n), names in ways.items():
        src = lines.where(F.col("test_set").isin(*names) & (F.col("role") == "src"))
        sources = [src.where(F.col("pos") == i).select(*keys, "text") for i in range(n)]
        done.append(translate_lines(sources[0], keys, processor, decoder_factory, models=models, extras=sources[1:]))
    return first_rank(reduce(DataFrame.unionByName, done)).withColumnRenamed("translation", "hyp")


def segments(lines: DataFrame, hyps: DataFrame) -> DataFrame:
    """``test_set, line_no, hyp, refs, query``, joined by set and line."""
    ref = F.when(F.col("role") == "ref", F.struct("pos", "text"))
    query = F.when(F.col("role") == "query", F.col("text"))
    sides = (lines.where("role <> 'src'").groupBy("test_set", "line_no")
             .agg(F.transform(F.array_sort(F.collect_list(ref)), lambda r: r["text"]).alias("refs"), F.max(query).alias("query"))
             .where(F.size("refs") > 0))
    return hyps.join(sides, ["test_set", "line_no"])


def score_catalogue(spark: SparkSession, catalogue: Mapping[str, Entry], decoder_factory: Callable | None = None,
                    models: Models | None = None, output: str | None = None) -> DataFrame:
    """E5: ``test_set, scorer, metric, value, error`` of all sets; written to ``output`` (K8) if given.

    A set with a missing file, or with references of another length than its
    source, is one row per fault with an ``error`` and no scorer; the other sets
    are scored all the same.  A set without sources or references raises."""
    for name, entry in catalogue.items():
        if not entry.src or not entry.ref:
            raise ValueError(f"test set {name} needs a source and a reference")
    faults = missing_files(spark, catalogue)
    errors = spark.createDataFrame(faults, "test_set string, error string")
    there = {name: entry for name, entry in catalogue.items() if name not in {n for n, _ in faults}}
    scores = spark.createDataFrame([], S.RESULT)
    if there:
        lines = materialize(read_sets(spark, there))       # read by every way of processing, numbered once
        unequal = unequal_sets(lines, there)
        asked = spark.createDataFrame([(n, s, dict(a)) for n, e in there.items() for s, a in e.scorers.items()],
                                      "test_set string, scorer string, args map<string,string>")
        found = segments(lines, translate_sets(lines, there, decoder_factory, models))
        scores = S.score(found, asked.join(unequal, "test_set", "left_anti"))
        errors = errors.unionByName(unequal)
    none = F.lit(None)
    scores = scores.unionByName(errors.select("test_set", none.cast("string").alias("scorer"), none.cast("string").alias("metric"),
                                              none.cast("double").alias("value"), "error"))
    if output is not None:
        write_scores(scores, output)
        scores = spark.read.schema(S.RESULT).json(output)
    return scores


def score_file(spark: SparkSession, src: str, ref: str, decoder_factory: Callable | None = None, **settings) -> DataFrame:
    """One source file against its reference; ``settings`` are an :class:`Entry`'s."""
    return score_catalogue(spark, {src: Entry([src], [ref], **settings)}, decoder_factory)
