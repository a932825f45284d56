"""Spark session helpers.

The library never creates a session behind the caller's back: every job takes
a ``SparkSession`` (or a DataFrame).  ``get_spark`` is a convenience for tests,
``bench.py`` and scripts; on a cluster the session comes from the launcher.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces small
# shuffle partitions at run time; skew-join splitting handles one hot
# document or test set holding a large share of all rows.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Text stages are CPU-bound per byte (regexes, array lambdas): AQE must
    # not merge small shuffles into one task.  Large inputs are unaffected.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tessera", extra_conf: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage and we only read it;
    a machine's own folder would be out of the executors' reach, so an unset
    one is an error there.  Only with a ``local`` master do we point it at a
    fresh scratch folder, so that ``DataFrame.checkpoint()`` works.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext (Spark Connect)
            current = None
    if not current:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[[^\]]*\])?$", master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder; master is {master!r}")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        spark.sparkContext.setCheckpointDir(current)
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        pass
    return current


def scratch_table_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for stage tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def materialize(df):
    """Cut lineage of an intermediate that several branches of a plan read.

    Reliable ``checkpoint()`` into the shared ``spark.checkpoint.dir`` (never
    ``localCheckpoint``): the stage survives executor loss and is computed
    once instead of once per consuming branch.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """``df`` written as a Parquet stage table of its own under the checkpoint dir, and read again.

    For wide or long stages: compressed columns, where a checkpoint holds plain rows."""
    path = f"{scratch_table_dir(df.sparkSession, name)}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
