"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, as Spark's Parquet reader splits it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


#: Spark's own setting: shuffle files go as soon as the statement that wrote them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: what follows is computed from files that outlive any
    executor, and a table that several branches read is computed once.  Nothing
    reads the shuffle files of the write again, so they are deleted with it.
    """
    spark = df.sparkSession
    path, before = shared_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*frames: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/llm/" not in folder:
                raise ValueError(f"not a staged table: {folder}")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(docs: DataFrame) -> DataFrame:
    """``doc`` (all columns of ``docs``) and ``row``, a number of its own for every
    row; written, so that every branch reads the same numbers."""
    return staged(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "rows")


def without(rows: DataFrame, lost: DataFrame) -> DataFrame:
    """The documents of ``rows(doc, row)`` whose row is not in ``lost(row)``."""
    gone = lost.select(F.col("row").alias("gone"))
    return rows.join(gone, F.col("row") == F.col("gone"), "left_anti").select("doc.*")


def ascii_lower(col):
    """A-Z lower-cased, nothing else."""
    return F.translate(col, UPPER, LOWER)


def fingerprint(edges: DataFrame) -> tuple:
    """Count and order-free hash of ``edges(u, v)``."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): ``node, root`` with the
    smallest reachable node as root, one row per node that is not a root itself.

    Alternating large-star / small-star rounds; their number grows with the
    logarithm of a component's size.  A node's neighbours are only reduced to a
    minimum, never listed.  The minima of the large star are written before the
    join, so that AQE can split a node with very many neighbours; below a node
    the large star leaves few, so the small star is a window.
    """
    current = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = fingerprint(current)
    for _ in range(max_rounds):
        # large star: every neighbour above the node links to the node's smallest neighbour
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small star: every neighbour below the node, and the node, link to the smallest of them
        down = large.select("u", "v", F.min("v").over(Window.partitionBy("u")).alias("m"))
        links = F.array(F.struct(F.col("v").alias("x"), F.col("m").alias("y")), F.struct(F.col("u").alias("x"), F.col("m").alias("y")))
        small = (down.select(F.explode(links).alias("e")).select(F.col("e.x").alias("u"), F.col("e.y").alias("v"))
                     .where("u <> v").distinct())
        after = staged(small, "edges")
        drop_staged(current, low)
        current, before, mark = after, mark, fingerprint(after)
        if mark == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
