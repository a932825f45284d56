"""Structured Streaming jobs.

All jobs are ordinary streaming queries over a file source; the checkpoint
location gives restart/resume (K11) and ``trigger(availableNow=True)`` is the
end-of-stream marker (T4).  T2 is stateless (a request is one row and its
pieces live in arrays inside that row); only T5 (join) and T6 (running ids)
hold state.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TT

from tessera.functions import text as T
from tessera.session import ensure_checkpoint_dir

REQUEST_SCHEMA = TT.StructType([
    TT.StructField("conv_id", TT.LongType()), TT.StructField("turn", TT.LongType()),
    TT.StructField("src_lang", TT.StringType()), TT.StructField("tgt_lang", TT.StringType()),
    TT.StructField("text", TT.StringType()), TT.StructField("query", TT.StringType())])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint dir for one run of a job."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"


def _cores(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def run_available_now(stream: DataFrame, sink: str, checkpoint: str, partition_by: list[str] | None = None,
                      fmt: str = "parquet", timeout_s: int | None = None, state_partitions: int | None = None) -> None:
    """Drain everything available into ``sink`` and stop (T4), however long it
    takes; only a caller's own ``timeout_s`` ends it earlier, with an error.

    A stateful query fixes its number of state-store partitions at its first
    run (then it is kept in the checkpoint); ``state_partitions`` sizes it to
    the cluster's cores instead of the session's batch shuffle setting."""
    spark = stream.sparkSession
    old = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions or _cores(spark)))
    try:
        _start_and_wait(stream, sink, checkpoint, partition_by, fmt, timeout_s)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _start_and_wait(stream, sink, checkpoint, partition_by, fmt, timeout_s):
    w = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start(sink)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream to {sink} did not finish in {timeout_s} s")
    if q.exception() is not None:
        raise q.exception()


def mux_demux(spark: SparkSession, source: str, schema: TT.StructType,
              transform: Callable[[Column], Column], sink: str, checkpoint: str, folders: int | None = None) -> DataFrame:
    """Stream every line of every document through a line-for-line
    transform and write the same layout (one folder per document).

    A corpus of very many documents gives ``folders``: a document is then in the
    folder ``part=`` its hash modulo that number, with its id in the rows, and
    the number of files no longer grows with the number of documents.

    Returns the sink; see :func:`line_counts` for the check of its lines."""
    lines = spark.readStream.schema(schema).json(source)
    out = lines.select("doc_id", "line_no", transform(F.col("text")).alias("text"))
    if folders is None:
        run_available_now(out, sink, checkpoint, partition_by=["doc_id"])
        return spark.read.parquet(sink)
    run_available_now(out.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(folders))), sink, checkpoint, partition_by=["part"])
    return spark.read.parquet(sink).drop("part")


def line_counts(source: DataFrame, sink: DataFrame, key: str = "doc_id") -> DataFrame:
    """T1's check: ``key, lines_in, lines_out, same`` of every document."""
    counts = (source.select(F.col(key).cast("string").alias(key), F.lit(1).alias("i"), F.lit(0).alias("o"))
              .unionByName(sink.select(F.col(key).cast("string").alias(key), F.lit(0).alias("i"), F.lit(1).alias("o")))
              .groupBy(key).agg(F.sum("i").alias("lines_in"), F.sum("o").alias("lines_out")))
    return counts.withColumn("same", F.col("lines_in") == F.col("lines_out"))


def translate_requests(stream: DataFrame, max_length: int = 200,
                       decode: Callable[[Column], Column] | None = None) -> DataFrame:
    """Request rows → one response row per line, or one error row.

    Stateless: F44 splits the message, P11 checks the query count, J7 zips
    lines with queries, F28 appends the query, and every line is wrapped,
    decoded piece by piece and re-joined inside its own row (no grouping).
    ``decode`` maps one piece (a Column) to its translation; identity here.
    """
    decode = decode or (lambda p: p)
    lines = T.split_message(F.col("text"))
    qs = F.when(F.col("query").isNotNull(), T.split_message(F.col("query")))
    m = stream.select("conv_id", "turn", lines.alias("lines"), qs.alias("qs"))
    m = m.withColumn("error", F.when(F.col("qs").isNotNull() & (F.size("qs") != F.size("lines")),
                                     F.lit("number of queries does not match number of lines")))
    # an error response belongs to the whole message: id -1 (no line)
    bad = m.filter(F.col("error").isNotNull()).select(
        "conv_id", "turn", F.lit(-1).cast("long").alias("id"), F.lit(None).cast("string").alias("translation"),
        "error")
    zipped = F.arrays_zip(F.col("lines").alias("l"), F.coalesce(F.col("qs"), F.array().cast("array<string>")).alias("q"))
    rows = m.filter(F.col("error").isNull()).select("conv_id", "turn", "qs", F.posexplode(zipped).alias("id", "z"))
    line = F.when(F.col("qs").isNull(), T.strip(F.col("z.l"))).otherwise(
        T.append_query(F.concat_ws("\t", F.col("z.l"), F.col("z.q"))))
    rows = rows.select("conv_id", "turn", F.col("id").cast("long").alias("id"), line.alias("line"))
    rows = rows.withColumn("_tok", T.tokens("line")).withColumn("_n", F.size("_tok"))
    m_ = F.lit(max_length)
    tok = F.col("_tok")
    pieces = F.when(F.col("_n") > m_, F.transform(
        F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / m_).cast("int")),
        lambda i: F.array_join(F.slice(tok, i * m_ + 1, m_), " "))).otherwise(F.array(F.col("line")))
    joined = F.array_join(F.transform(pieces, lambda p: T.strip(decode(p))), " ")
    good = rows.select("conv_id", "turn", "id", F.when(T.is_blank("line"), F.lit("")).otherwise(joined)
                       .alias("translation"), F.lit(None).cast("string").alias("error"))
    return bad.unionByName(good)


def correlate(requests: DataFrame, results: DataFrame, key: str = "request_id",
              max_delay: str = "5 minutes", watermark: str = "10 minutes") -> DataFrame:
    """Stream-stream inner join of requests with their results.

    Both sides carry an event-time watermark and the join has a time-range
    condition, so join state is bounded and evicted.  (The reference relies
    on FIFO order instead.)"""
    req = requests.withWatermark("req_ts", watermark).alias("q")
    res = results.withWatermark("res_ts", watermark).alias("r")
    cond = ((F.col(f"q.{key}") == F.col(f"r.{key}"))
            & (F.col("r.res_ts") >= F.col("q.req_ts"))
            & (F.col("r.res_ts") <= F.col("q.req_ts") + F.expr(f"INTERVAL {max_delay}")))
    return req.join(res, cond, "inner")


def number_lines(stream: DataFrame, key: str, order: str, sink: str, checkpoint: str) -> None:
    """Drain ``stream`` into ``sink`` with ``sent_id``, a dense running
    number per ``key`` that goes on from micro-batch to micro-batch.

    Within a batch rows are numbered by ``order`` with the bucketed prefix sum,
    so a key that holds most rows is still many tasks; between batches only
    one count per key is carried, as a table of the batch before.  Each batch
    writes folders of its own number, so a batch that is run again after a
    failure replaces what it wrote.
    """
    from tessera.operators.prefix import prefix_sum
    counts = f"{checkpoint}-counts"
    columns = [c for c in stream.columns if c != key]

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        first = spark.createDataFrame([], f"{key} {rows.schema[key].dataType.simpleString()}, next_id long")
        if number:
            first = spark.read.schema(first.schema).parquet(f"{counts}/batch={number - 1}")
        rows = rows.withColumn("_one", F.lit(1).cast("long"))
        placed = prefix_sum(rows.withColumn("_key", F.coalesce(F.col(key).cast("string"), F.lit("\0"))), order, "_one", "_at", ["_key"])
        before = first.select(F.coalesce(F.col(key).cast("string"), F.lit("\0")).alias("_key"), F.col("next_id").alias("_first"))
        out = placed.join(before, "_key", "left").select(
            key, *columns, (F.coalesce("_first", F.lit(0)) + F.col("_at")).cast("long").alias("sent_id"))
        out.write.mode("overwrite").parquet(f"{sink}/batch={number}")
        (first.unionByName(spark.read.parquet(f"{sink}/batch={number}").groupBy(key).agg((F.max("sent_id") + 1).alias("next_id")))
              .groupBy(key).agg(F.max("next_id").alias("next_id")).write.mode("overwrite").parquet(f"{counts}/batch={number}"))

    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
