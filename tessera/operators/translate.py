"""End-to-end translation jobs (E1, E2, E6, E8) and sinks.

``translate_lines`` is the reference's translate-folder pipeline as one
Spark plan: lines → placeholder extraction (F30) → pre-processing → wrap
(P1) → decoder hook (X4) → regroup and zip n-best ranks (A1-A3) →
post-processing and re-insertion (F31) → blank empties (P6) → expand (P8).
``translate_folder`` adds the folder source (S1) and the same-layout sink
(K4); stage tables make a re-run skip finished stages (K11).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.processors import Models, TextProcessor, encode_lines
from tessera.operators import decode, placeholders, wrap
from tessera.sources.tables import BIG_FILE, read_folder


def translate_lines(lines: DataFrame, keys=("doc", "line_no"), processor: TextProcessor | None = None,
                    decoder_factory: Callable | None = None, n_best: int = 1, extract_tags: bool = False,
                    max_length: int = wrap.MAX_SENTENCE_LENGTH, models: Models | None = None,
                    extras: Sequence[DataFrame] = (), words: bool = False, expand: bool = True) -> DataFrame:
    """``keys…, rank, translation`` for every line (empty lines give '').

    ``words`` adds ``nbest_words``: of every position of the line the decoder's
    alternatives with their scores (the decoder must give them, see
    ``decode.batch_decode``); an empty line has none.  Without ``expand`` (P8) a
    line is one row and both columns are arrays by rank.

    A processor with corpus steps (truecasing, subwords) needs its ``models``.
    ``extras`` (S5/P3) are further sources, ``keys…, text`` each: the line with the
    same keys goes, pre-processed, to the decoder with every piece of the main
    line; a missing line is an empty text.  The decoder must be given then."""
    keys = list(keys)
    if extras and decoder_factory is None:
        raise ValueError("extra sources need a decoder that takes them")
    proc = processor or TextProcessor()
    df = lines
    tags = None
    if extract_tags:
        df = placeholders.extract_placeholders(df, "text", "text", "tags")
        tags = "tags"
    if proc.truecases or proc.subwords:
        df, before = encode_lines(df, proc, models, keys, keep=[tags] if tags else []), None
    else:
        before = proc.pre
    pieces = wrap.wrap_lines(df, keys=keys, before_wrap=before, after_wrap=proc.pre_piece,
                             keep=[tags] if tags else [])
    names = [f"_extra{i}" for i in range(len(extras))]
    for name, other in zip(names, extras):
        line = T.strip(proc.pre_piece(T.strip(proc.pre(T.strip(F.col("text"))))))
        pieces = pieces.join(other.select(*keys, line.alias(name)), keys, "left").withColumn(name, F.coalesce(name, F.lit("")))
    if decoder_factory is None:
        hyps = decode.echo_decode(pieces, n_best, words=words)
    else:
        hyps = decode.batch_decode(pieces, decoder_factory, n_best, keys=[*keys, "piece_no"], extras=names, words=words)
    found = "nbest_words" if words else None
    if not expand:
        return wrap.collate_pieces(hyps, keys=keys, words=found, postprocess=proc.post, tags=tags, n_best=n_best)
    return wrap.unwrap_pieces(hyps, keys=keys, words=found, postprocess=proc.post, tags=tags)


def _sorted_maps(position: Column) -> Column:
    """A position's alternatives in the order of their text (keys of JSON are sorted)."""
    return F.map_from_entries(F.array_sort(F.map_entries(position)))


def format_rows(out: DataFrame, fmt: str, id_col: str = "line_no") -> DataFrame:
    """K1/K2/K3: one output text line per row.

    JSON has ``nbest_words`` where the rows have them, and takes expanded and
    unexpanded rows; the other formats have one hypothesis per line and raise
    ValueError on unexpanded rows."""
    types = dict(out.dtypes)
    arrays = types["translation"].startswith("array")
    if arrays and fmt in ("marian", "text"):
        raise ValueError(f"format {fmt!r} needs one row per hypothesis")
    if fmt == "json":
        fields = [F.col(id_col).alias("id"), F.col("translation")]
        if "nbest_words" in types:
            ordered = (F.transform("nbest_words", lambda h: F.transform(h, _sorted_maps)) if arrays
                       else F.transform("nbest_words", _sorted_maps))
            fields.insert(1, ordered.alias("nbest_words"))
        line = F.to_json(F.struct(*fields))
    elif fmt == "marian":
        line = F.concat_ws(" ||| ", F.col(id_col).cast("string"), F.trim("translation"))
    elif fmt == "text":
        line = F.trim("translation")
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return out.withColumn("value", line)


def stage_done(spark: SparkSession, path: str) -> bool:
    """A stage table is finished when its ``_SUCCESS`` marker exists."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return p.getFileSystem(jsc.hadoopConfiguration()).exists(p)


def _name_of(factory: Callable | None) -> str:
    """What a decoder is known by in a stage's name."""
    return "echo" if factory is None else f"{factory.__module__}.{factory.__qualname__}"


def translate_folder(spark: SparkSession, input_dir: str, output_dir: str, processor: TextProcessor | None = None,
                     decoder_factory: Callable | None = None, n_best: int = 1, fmt: str = "json",
                     extract_tags: bool = False, glob: str | None = None, models: Models | None = None,
                     big: int = BIG_FILE, extra_dirs: Sequence[str] = (), words: bool = False,
                     expand: bool = True) -> str:
    """Translate every file under ``input_dir`` into the same layout.

    Files of ``big`` bytes or more are read, translated and put together again by
    many tasks; no step holds more than a line of a document.  ``extra_dirs`` are
    folders of the same layout that hold further sources, line by line.  ``words``
    and ``expand`` are those of :func:`translate_lines`; the stage holds them.

    Output rows are written partitioned by document (``doc=<relative path>``)
    and sorted by line (and rank) inside each file.  The parsed stage is named
    after what made it (input, processor, decoder, n-best, tags, glob, words, form): a run
    with the same arguments reuses a finished one, other arguments get their
    own, and one without its success marker is written again (resume)."""
    made = "|".join(str(x) for x in (input_dir, (processor or TextProcessor()).name, _name_of(decoder_factory), n_best, extract_tags, glob,
                                  *extra_dirs, *(["words"] if words else []), *([] if expand else ["arrays"])))
    stage = f"{output_dir.rstrip('/')}/_stages/hyps-{hashlib.sha256(made.encode()).hexdigest()[:16]}"
    if not stage_done(spark, stage):
        lines = read_folder(spark, input_dir, glob, big)
        extras = [read_folder(spark, d, glob, big) for d in extra_dirs]
        out = translate_lines(lines, processor=processor, decoder_factory=decoder_factory, n_best=n_best,
                              extract_tags=extract_tags, models=models, extras=extras, words=words, expand=expand)
        out.write.mode("overwrite").parquet(stage)                            # K5
    hyps = spark.read.parquet(stage)
    rows = format_rows(hyps, fmt)
    # Range partitioning keeps each document's rows contiguous and ordered
    # across part files, and splits one huge document over several tasks.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc", "line_no", "rank"] if expand else ["doc", "line_no"]
    (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
         .select("doc", "value").write.mode("overwrite").partitionBy("doc").text(f"{output_dir.rstrip('/')}/out"))
    return f"{output_dir.rstrip('/')}/out"
