"""Translation of a stream of lines by a decoder that answers piece by piece.

Three streaming queries, connected by folders (queues on a cluster), take the
places of the writer, the decoder and the reader of a line-by-line translation:

* ``send_pieces``: lines → pieces with their keys (stateless, no shuffle);
* ``decode_stream``: pieces → their hypotheses (stateless, Arrow batches);
* ``collect_lines``: hypotheses → lines, as soon as all pieces of a line are there,
  whatever their order.  Pieces of unfinished lines wait in a table per batch.

Each batch of ``collect_lines`` reads the waiting pieces of the batch before and
replaces its own folders, so a batch that is run again after a failure gives the
same lines.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.processors import TextProcessor
from tessera.operators import decode, placeholders, wrap
from tessera.session import materialize
from tessera.streaming.jobs import run_available_now

KEYS = ("doc_id", "line_no")


def _plain(processor: TextProcessor | None) -> TextProcessor:
    processor = processor or TextProcessor()
    if processor.truecases or processor.subwords:
        raise ValueError(f"processor {processor.name} needs corpus models; a stream of lines has none")
    return processor


def send_pieces(lines: DataFrame, keys: Sequence[str] = KEYS, processor: TextProcessor | None = None,
                extract_tags: bool = False, max_length: int = wrap.MAX_SENTENCE_LENGTH) -> DataFrame:
    """``keys…, tags, is_empty, n_pieces, piece_no, text`` of ``keys…, text``; a null text is an empty line."""
    proc = _plain(processor)
    df = lines.select(*keys, F.coalesce("text", F.lit("")).alias("text"))
    if extract_tags:
        df = placeholders.extract_placeholders(df, "text", "text", "tags")
    else:
        df = df.withColumn("tags", F.array().cast(placeholders.TAGS_TYPE))
    return wrap.wrap_lines(df, keys, max_length=max_length, before_wrap=proc.pre, after_wrap=proc.pre_piece, keep=["tags"])


def decode_stream(pieces: DataFrame, factory: Callable[[], decode.Decoder], n_best: int = 1) -> DataFrame:
    """Replaces ``text`` by ``hyps``: at most ``n_best`` hypotheses of every piece, best first.

    ``factory()`` is called once a task; see ``decode.Decoder``."""
    kept = [c for c in pieces.columns if c != "text"]
    tags = pieces.schema["tags"].dataType
    sent = pieces.withColumn("tags", F.to_json("tags"))        # structs would become rows in pandas
    schema = ", ".join(f"`{f.name}` {'string' if f.name == 'tags' else f.dataType.simpleString()}"
                       for f in pieces.schema.fields if f.name != "text") + ", hyps array<string>"

    def run(batches):
        model = factory()
        for pdf in batches:
            hyps = [list(h)[:n_best] for h in model(pdf["text"].tolist())]
            yield pdf[kept].assign(hyps=hyps)

    return sent.mapInPandas(run, schema).withColumn("tags", F.from_json("tags", tags))


def _whole_lines(grouped: DataFrame, keys: Sequence[str], n_best: int, processor: TextProcessor) -> DataFrame:
    """``keys…, rank, translation`` of lines whose pieces are all there, an empty line blank at each of ``n_best`` ranks."""
    df = grouped.withColumn("_parts", F.array_sort("_parts"))
    shared = F.array_min(F.transform("_parts", lambda p: F.size(p["hyps"])))
    df = df.withColumn("_k", F.when(F.col("is_empty"), F.lit(n_best)).otherwise(shared)).where("_k > 0")
    df = df.withColumn("rank", F.explode_outer(F.sequence(F.lit(0), F.col("_k") - 1)))    # never empty
    df = df.withColumn("_joined", F.array_join(F.transform("_parts", lambda p: T.strip(F.get(p["hyps"], F.col("rank")))), " "))
    df = df.withColumn("_post", T.strip(processor.post(F.col("_joined"))))
    text = F.when(F.col("is_empty"), F.lit("")).otherwise(placeholders.reinsert_column(F.col("_post"), F.col("tags")))
    return df.select(*keys, F.col("rank").cast("int").alias("rank"), text.alias("translation"))


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _forget(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def collect_lines(decoded: DataFrame, sink: str, checkpoint: str, keys: Sequence[str] = KEYS, n_best: int = 1,
                  processor: TextProcessor | None = None) -> None:
    """Drain ``decoded`` (a stream of :func:`decode_stream`'s rows) into ``sink``: ``keys…, rank, translation``.

    A line is written in the batch that brings its last piece; a rank that some piece
    lacks is left out.  A piece that comes twice, with the same hypotheses, while its line waits counts once; the
    stream must not bring pieces of a line that is finished.  One shuffle a batch, on
    the line's keys; the waiting table holds only pieces of unfinished lines, and
    that of a batch is deleted once the next but one no longer needs it."""
    keys, proc = list(keys), _plain(processor)
    waiting = f"{checkpoint}-waiting"
    schema = decoded.schema

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        if number:
            rows = rows.unionByName(spark.read.schema(schema).parquet(f"{waiting}/batch={number - 1}"))
        # one row a piece without a shuffle of its own: equal pieces fall together in the line's array
        grouped = materialize(rows.groupBy(*keys).agg(
            F.collect_set(F.struct("piece_no", "hyps")).alias("_parts"), F.max("n_pieces").alias("n_pieces"),
            F.first("is_empty").alias("is_empty"), F.first("tags").alias("tags")))
        done = F.size("_parts") == F.col("n_pieces")
        _write(_whole_lines(grouped.where(done), keys, n_best, proc), f"{sink}/batch={number}")
        rest = grouped.where(~done).select("*", F.explode("_parts").alias("_p")).select("*", "_p.*")
        _write(rest.select(*schema.names), f"{waiting}/batch={number}")
        if number > 1:
            _forget(spark, f"{waiting}/batch={number - 2}")

    q = decoded.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def waiting_pieces(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Pieces of lines that were not finished in the last batch."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}-waiting")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    last = max(int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(folder))      # two or three folders
    return spark.read.parquet(f"{checkpoint}-waiting/batch={last}")


def translate_stream(spark: SparkSession, lines: DataFrame, folder: str, factory: Callable[[], decode.Decoder], n_best: int = 1,
                     keys: Sequence[str] = KEYS, processor: TextProcessor | None = None, extract_tags: bool = False,
                     max_length: int = wrap.MAX_SENTENCE_LENGTH, files_per_batch: int | None = None) -> DataFrame:
    """All three queries over ``lines`` (a stream), as far as input is there; a later call goes on.

    ``folder`` (shared storage) holds the queues, the checkpoints and the result, which is returned."""
    pieces = send_pieces(lines, keys, processor, extract_tags, max_length)
    run_available_now(pieces, f"{folder}/pieces", f"{folder}/ckpt-pieces")
    read = spark.readStream.schema(spark.read.parquet(f"{folder}/pieces").schema)
    decoded = decode_stream(read.parquet(f"{folder}/pieces"), factory, n_best)
    run_available_now(decoded, f"{folder}/decoded", f"{folder}/ckpt-decoded")
    back = spark.readStream.schema(spark.read.parquet(f"{folder}/decoded").schema)
    if files_per_batch:
        back = back.option("maxFilesPerTrigger", files_per_batch)
    collect_lines(back.parquet(f"{folder}/decoded"), f"{folder}/lines", f"{folder}/ckpt-lines", keys, n_best, processor)
    return spark.read.parquet(f"{folder}/lines").drop("batch")
