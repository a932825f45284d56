"""Corpus queries: lines, wrapping, regrouping, offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import decode, prefix, wrap
from tessera.plans.registry import register
from tessera.plans.sqlparts import LINES, PIECES, pieces_sql, with_

BLANKED = ("blanked AS (SELECT doc_id, line_no, CASE WHEN line_no % 17 = 0 THEN '' ELSE text END AS text "
           "FROM lines)")
from tessera.session import materialize
from tessera.sources.tables import document_lines, read_table


def lines_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def pieces_of(spark: SparkSession, sf_dir: str, max_length: int = wrap.MAX_SENTENCE_LENGTH) -> DataFrame:
    return wrap.wrap_lines(lines_of(spark, sf_dir), max_length=max_length)


@register("doc_lines", with_(LINES) + "SELECT doc_id, line_no, text FROM lines")
def doc_lines(spark, sf_dir):
    """Documents → dense 0-based lines."""
    return lines_of(spark, sf_dir)


@register("wrap_pieces", with_(LINES, PIECES) + "SELECT * FROM pieces")
def wrap_pieces(spark, sf_dir):
    """Lines of more than 200 tokens become pieces of at most 200."""
    return pieces_of(spark, sf_dir)


@register("wrap_unwrap_roundtrip", with_(LINES, PIECES) + r"""
, _lines AS (SELECT doc_id, line_no, bool_or(is_empty) AS is_empty,
                    string_agg(trim(text), ' ' ORDER BY piece_no) AS joined FROM pieces GROUP BY 1, 2)
SELECT doc_id, line_no, r AS rank,
       CASE WHEN is_empty THEN '' WHEN r = 0 THEN joined ELSE lower(joined) END AS translation
FROM _lines, (SELECT CAST(unnest([0, 1]) AS INTEGER) AS r)
""")
def wrap_unwrap_roundtrip(spark, sf_dir):
    """E1 without a model: wrap → 2-best echo decoder → zip ranks and regroup."""
    hyps = decode.echo_decode(pieces_of(spark, sf_dir), n_best=2)
    return wrap.unwrap_pieces(hyps)


def local_items(pieces: DataFrame) -> DataFrame:
    """Position of every piece inside its own document (the reference's
    per-file item id): pieces of earlier lines plus ``piece_no``."""
    per_line = pieces.filter("piece_no = 0").select("doc_id", "line_no", "n_pieces")
    starts = prefix.prefix_sum(per_line, "line_no", "n_pieces", "_line_first", group=["doc_id"])
    return (pieces.join(starts.select("doc_id", "line_no", "_line_first"), ["doc_id", "line_no"])
            .withColumn("local_item", (F.col("_line_first") + F.col("piece_no")).cast("long"))
            .drop("_line_first"))


def doc_ranges(pieces: DataFrame) -> DataFrame:
    """``doc_stats(doc_id, n_pieces, first_piece)`` — one row per document,
    documents concatenated in ``doc_id`` order."""
    per_doc = pieces.groupBy("doc_id").agg(F.count("*").alias("n_pieces"))
    return prefix.prefix_sum(per_doc, "doc_id", "n_pieces", "first_piece")


def global_items(pieces: DataFrame) -> DataFrame:
    """W1/W4 over the whole corpus: the global position of every piece in
    (doc_id, line_no, piece_no) order = document start + position inside it."""
    docs = doc_ranges(pieces).select("doc_id", "first_piece")
    return (local_items(pieces).join(docs, "doc_id")
            .withColumn("item", F.col("first_piece") + F.col("local_item")).drop("first_piece"))


def range_join_items(items: DataFrame, docs: DataFrame, block: int = 1 << 16) -> DataFrame:
    """Which document owns global item k (``first <= k < first + n``).

    The ranges are ordered and disjoint, so the owner is the last document that
    starts at or before the item.  Starts and items meet in one stream per
    block of ``block`` positions (a document has a start in each block it
    spans), and a window carries the last start forward: every item meets one
    candidate, a block is a bounded number of rows, and nothing is broadcast.
    """
    spans = docs.select("doc_id", "first_piece", "n_pieces", F.explode(F.sequence(
        F.expr(f"first_piece div {block}L"), F.expr(f"(first_piece + n_pieces - 1) div {block}L"))).alias("_blk"))
    starts = spans.select("_blk", F.greatest("first_piece", F.col("_blk") * block).alias("item"), F.lit(0).alias("_kind"),
                          F.struct("doc_id", "first_piece", "n_pieces").alias("_doc"))
    rows = items.select(F.expr(f"item div {block}L").alias("_blk"), "item", F.lit(1).alias("_kind"),
                        F.lit(None).cast(starts.schema["_doc"].dataType).alias("_doc"))
    ahead = Window.partitionBy("_blk").orderBy("item", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    owned = starts.unionByName(rows).withColumn("_doc", F.last("_doc", ignorenulls=True).over(ahead))
    return (owned.filter((F.col("_kind") == 1) & (F.col("item") < F.col("_doc.first_piece") + F.col("_doc.n_pieces")))
                 .select("item", "_doc.*"))


@register("doc_offsets_range_join", with_(LINES, PIECES) + r"""
, docs AS (SELECT doc_id, count(*) AS n_pieces FROM pieces GROUP BY 1),
doff AS (SELECT doc_id, n_pieces,
                coalesce(sum(n_pieces) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS first_piece FROM docs),
items AS (SELECT row_number() OVER (ORDER BY doc_id, line_no, piece_no) - 1 AS item FROM pieces)
SELECT CAST(i.item AS BIGINT) AS item, d.doc_id, CAST(d.first_piece AS BIGINT) AS first_piece,
       CAST(i.item - d.first_piece AS BIGINT) AS local_item
FROM items i JOIN doff d ON i.item >= d.first_piece AND i.item < d.first_piece + d.n_pieces
""")
def doc_offsets_range_join(spark, sf_dir):
    """W4 + J2: decoder items carry only a global position; give them back their document."""
    pieces = materialize(pieces_of(spark, sf_dir))        # stage table, read by three branches
    items = global_items(pieces).select("item")          # what a raw decoder stream knows
    docs = doc_ranges(pieces)
    owned = range_join_items(items, docs)
    return owned.select("item", "doc_id", F.col("first_piece").cast("long").alias("first_piece"),
                        (F.col("item") - F.col("first_piece")).cast("long").alias("local_item"))


def lines_with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with injected blank lines (every line_no divisible by 17)."""
    return lines_of(spark, sf_dir).withColumn(
        "text", F.when(F.col("line_no") % 17 == 0, F.lit("")).otherwise(F.col("text")))


@register("empty_line_report", with_(LINES, BLANKED, pieces_sql("blanked")) + r"""
, per_line AS (SELECT doc_id, line_no, bool_or(is_empty) AS is_empty, max(n_pieces) AS n_pieces
               FROM pieces GROUP BY 1, 2),
  ntok AS (SELECT doc_id, line_no, len(tok) AS n_tokens FROM _t)
SELECT doc_id, count(*) AS n_lines, CAST(count_if(is_empty) AS BIGINT) AS n_empty,
       min(CASE WHEN is_empty THEN line_no END) AS first_empty,
       max(CASE WHEN is_empty THEN line_no END) AS last_empty,
       CAST(sum(n_pieces) AS BIGINT) AS n_pieces, CAST(max(n_tokens) AS INTEGER) AS max_tokens,
       CAST(count_if(n_pieces > 1) AS BIGINT) AS n_wrapped
FROM per_line JOIN ntok USING (doc_id, line_no) GROUP BY doc_id
""")
def empty_line_report(spark, sf_dir):
    """Per-document QA totals (lines, empties, pieces)."""
    lines = lines_with_blanks(spark, sf_dir)
    pieces = wrap.wrap_lines(lines.withColumn("n_tokens", F.size(T.tokens("text"))), keep=["n_tokens"])
    per_line = pieces.filter("piece_no = 0")
    return per_line.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"),
        F.count_if("is_empty").alias("n_empty"),
        F.min(F.when(F.col("is_empty"), F.col("line_no"))).alias("first_empty"),
        F.max(F.when(F.col("is_empty"), F.col("line_no"))).alias("last_empty"),
        F.sum("n_pieces").cast("long").alias("n_pieces"),
        F.max("n_tokens").alias("max_tokens"),
        F.count_if(F.col("n_pieces") > 1).alias("n_wrapped"))
