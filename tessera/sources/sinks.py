"""Sinks (K6-K9).  All writes go through the DataFrame writer; nothing is
collected to the driver except the aggregate-sized score table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tags(df: DataFrame, path: str, keys=("doc", "line_no"), tags: str = "tags") -> None:
    """K6: tags as JSON lists ``[[placeholder, original], …]`` next to the keys."""
    as_lists = F.transform(tags, lambda t: F.array(t["placeholder"], t["original"]))
    df.select(*keys, F.to_json(as_lists).alias("tags")).write.mode("errorifexists").parquet(path)


def write_training_sets(pairs: DataFrame, path: str) -> None:
    """K7: ``set=train|valid`` folders holding input, output and (valid) ref columns."""
    pairs.write.mode("errorifexists").partitionBy("set").parquet(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """K8: the results table (a few rows per test set) as one JSON file."""
    scores.coalesce(1).write.mode("overwrite").json(path)


def tee_raw(raw: DataFrame, path: str) -> DataFrame:
    """K9: keep the raw decoder output before parsing, and parse from the copy."""
    raw.write.mode("errorifexists").parquet(path)
    return raw.sparkSession.read.parquet(path)
