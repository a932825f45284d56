"""Exact dedup with a heavy-hitter split.

A Misra-Gries summary (Spark's ``approx_top_k``, the frequent-items sketch of
the Misra-Gries family, with ``slots`` counters) finds every digest that makes
up more than ``1 / slots`` of the rows.  The candidates are counted exactly;
the verified winners, at most ``winners`` rows of one digest, one id and one
count, are broadcast and settle their rows map-side.  All other digests, whose
groups are now small against the whole, go through one ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged

WINNERS = 256
SLOTS = 4096


def text_digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, lowercase hex; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def heavy_digests(digests: DataFrame, winners: int = WINNERS, slots: int = SLOTS) -> list[str]:
    """Candidates of the Misra-Gries summary over ``digests(digest)``, most frequent first."""
    top = digests.agg(F.expr(f"approx_top_k(digest, {min(winners, slots)}, {slots})").alias("top")).first()["top"]
    return [x["item"] for x in top or [] if x["count"] > 1]


def verified_winners(digests: DataFrame, slots: int = SLOTS, winners: int = WINNERS) -> DataFrame:
    """``digest, keep, size`` of the candidates that exact counts confirm."""
    cands = heavy_digests(digests, winners, slots)
    rows = digests.agg(F.count("*")).first()[0]
    return (digests.where(F.col("digest").isin(cands) if cands else F.lit(False))
                   .groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("size"))
                   .where((F.col("size") > 1) & (F.col("size") >= rows / slots)))


def mark_copies(docs: DataFrame, key: str = "doc_id", text: str = "text",
                winners: int = WINNERS, slots: int = SLOTS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical; a null text counts as empty.  Of equal
    texts the row with the largest ``doc_id`` stays; of rows that also share
    it, exactly one (a null id counts as smallest).  An empty table gives an
    empty result; other columns are not read.  The text is read once: what
    follows works on a written table of ids and digests.
    """
    digests = staged(docs.select(F.col(key).alias("doc_id"), text_digest(F.col(text)).alias("digest"),
                                 F.monotonically_increasing_id().alias("row")), "digests")
    heavy = staged(verified_winners(digests, slots, winners), "winners")
    joined = digests.join(F.broadcast(heavy), "digest", "left")
    settled = joined.where("size is not null")
    same = Window.partitionBy("digest")
    ordinary = (joined.where("size is null").drop("keep", "size")
                      .select("*", F.max(F.struct("doc_id", "row")).over(same).alias("keep"),
                              F.count("*").over(same).alias("size")))
    return (settled.unionByName(ordinary)
                   .select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
                           (F.col("row") == F.col("keep.row")).alias("kept"), F.col("digest").alias("text_sha256")))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text",
                winners: int = WINNERS, slots: int = SLOTS) -> DataFrame:
    """``docs`` without copies, all columns kept; the same rows stay as in :func:`mark_copies`.

    Copies of a heavy text that are not its winner leave on the map side; only
    what is left is shuffled by digest, so no heavy group meets in one task.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.col(key).alias("doc_id"), text_digest(F.col(text)).alias("digest"))
    digests = staged(rows.select("doc_id", "digest", F.lit(0).alias("row")), "digests")
    heavy = staged(verified_winners(digests, slots, winners).select("digest", F.col("keep.doc_id").alias("winner"),
                                                                     F.lit(True).alias("heavy")), "winners")
    rest = (rows.join(F.broadcast(heavy), "digest", "left")
                .where(F.col("heavy").isNull() | F.col("doc_id").eqNullSafe(F.col("winner"))))
    order = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last())
    return rest.withColumn("n", F.row_number().over(order)).where("n = 1").select("doc.*")
