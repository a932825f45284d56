"""Wrapping long lines into pieces and putting decoded pieces back.

The reference keeps a positional ``true_ids`` list next to one big text file.
Here every piece carries its key ``(doc, line_no, piece_no)``, so the piece →
line mapping is data and the regrouping is one shuffle on ``(doc, line_no)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T

# Fixed value: default wrap length in tokens (the reference's default).
MAX_SENTENCE_LENGTH = 200

ColumnFn = Callable[[Column], Column]

#: Marks between the positions of a packed word list (a space: the keys are then mostly the text once more, which
#: compresses well) and between the entries of a position.
BETWEEN_POSITIONS, BETWEEN_ENTRIES = " ", "\x1f"


def packed_words(words: str) -> list[Column]:
    """A word list as the fields ``w``, ``v`` and ``m`` of a struct to be shuffled: its keys and
    its values as one text each, a fraction of the size of its maps, or, when these would not
    tell it (an empty list or position, a null, a mark in a text), the list itself."""
    def joined(of):
        texts = F.transform(F.col(words), lambda m: F.array_join(F.transform(of(m), lambda x: F.coalesce(x, F.lit(BETWEEN_POSITIONS))), BETWEEN_ENTRIES))
        return F.array_join(texts, BETWEEN_POSITIONS)

    def marks(text):
        return F.length(text) - F.length(F.translate(text, BETWEEN_POSITIONS + BETWEEN_ENTRIES, ""))

    w, v = joined(F.map_keys), joined(F.map_values)
    between = F.aggregate(F.col(words), F.lit(-1), lambda n, m: n + F.size(m))
    plain = F.coalesce((marks(w) == between) & (marks(v) == between), F.lit(False))
    return [F.when(plain, w).alias("w"), F.when(plain, v).alias("v"), F.when(~plain, F.col(words)).alias("m")]


def unpacked_words(part: Column) -> Column:
    """The word list of :func:`packed_words`."""
    positions = F.arrays_zip(F.split(part["w"], BETWEEN_POSITIONS, -1).alias("w"), F.split(part["v"], BETWEEN_POSITIONS, -1).alias("v"))
    maps = F.transform(positions, lambda p: F.map_from_arrays(F.split(p["w"], BETWEEN_ENTRIES, -1), F.split(p["v"], BETWEEN_ENTRIES, -1)))
    return F.coalesce(maps, part["m"])


def wrap_lines(lines: DataFrame, keys: Sequence[str] = ("doc_id", "line_no"), text: str = "text",
               max_length: int = MAX_SENTENCE_LENGTH, before_wrap: ColumnFn | None = None,
               after_wrap: ColumnFn | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``lines`` → ``pieces(keys…, is_empty, n_pieces, piece_no, text)``.

    A line of more than ``max_length`` whitespace tokens becomes
    ``ceil(n / max_length)`` pieces of single-space-joined tokens; any other
    line stays one piece, stripped but with inner whitespace kept.  The hooks
    are P4: ``before_wrap`` runs on the line, ``after_wrap`` on each piece.
    ``is_empty`` (D4/P5) is judged on the stripped input line; ``n_pieces``
    travels with each piece so regrouping never needs a second pass.

    Narrow (no shuffle).  The token array is projected as a column before the
    slicing lambda so Spark computes it once per line, not once per piece.  The
    outer explode keeps it so (every line has a piece): before a plain one Spark
    filters out empty arrays, and in that filter each piece would split its line.
    """
    line = T.strip(F.col(text))
    if before_wrap is not None:
        line = before_wrap(line)
    base = lines.select(*keys, *keep, T.is_blank(F.col(text)).alias("is_empty"), line.alias("_line"))
    base = base.withColumn("_tok", T.tokens("_line")).withColumn("_n", F.size("_tok"))
    m = F.lit(max_length)
    tok = F.col("_tok")
    sliced = F.transform(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / m).cast("int")),
                         lambda i: F.array_join(F.slice(tok, i * m + 1, m), " "))
    after = after_wrap or (lambda c: c)
    pieces = F.when(F.col("_n") > m, F.transform(sliced, lambda p: T.strip(after(p)))).otherwise(
        F.array(T.strip(after(F.col("_line")))))
    return (base.select(*keys, *keep, "is_empty", pieces.alias("_p"))
                .select(*keys, *keep, "is_empty", F.size("_p").alias("n_pieces"),
                        F.posexplode_outer("_p").alias("piece_no", "text")))


def unwrap_pieces(hyps: DataFrame, keys: Sequence[str] = ("doc_id", "line_no"),
                  text: str = "translation", rank: str | None = "rank",
                  n_pieces: str | None = "n_pieces", is_empty: str | None = "is_empty",
                  words: str | None = None, postprocess: ColumnFn | None = None,
                  tags: str | None = None) -> DataFrame:
    """Decoded pieces → one row per (line, rank).

    ``hyps`` holds ``keys…, piece_no, rank, translation`` (+ ``n_pieces``,
    ``is_empty``, word alternatives, tags).  The n-best ranks of the pieces are
    zipped like Python ``zip``: a rank is kept only when every piece of the
    line has it.  One hash shuffle on ``keys``; the aggregate runs partial
    then final, the collected array is bounded by the pieces of one line.
    """
    keys = list(keys)
    df = hyps
    if rank is None:
        df = df.withColumn("rank", F.lit(0))
        rank = "rank"
    if n_pieces is None:
        df = df.withColumn("n_pieces", F.max("piece_no").over(Window.partitionBy(*keys)) + 1)
        n_pieces = "n_pieces"
    carry = [F.first(c).alias(c) for c in (is_empty, tags) if c]
    parts = F.struct(F.col("piece_no"), F.col(text).alias("t"),
                     *(packed_words(words) if words else []))
    if words:
        df = df.select(*keys, rank, n_pieces, *(c for c in (is_empty, tags) if c), parts.alias("_part"))
        df = df.repartition(*keys)          # the ranks of a line side by side: their words are nearly the same
        parts = F.col("_part")
    grouped = (df.groupBy(*keys, rank)
                 .agg(F.count("*").alias("_have"), F.max(n_pieces).alias("_need"),
                      F.collect_list(parts).alias("_parts"), *carry)
                 .filter(F.col("_have") == F.col("_need")))
    # sort_array cannot order structs holding maps; a comparator on piece_no can.
    ordered = F.array_sort("_parts", lambda l, r: (l["piece_no"] - r["piece_no"]).cast("int"))
    joined = F.array_join(F.transform(ordered, lambda p: T.strip(p["t"])), " ")
    if postprocess is not None:
        joined = T.strip(postprocess(joined))
    if tags:
        from tessera.operators.placeholders import reinsert_column
        joined = F.when(F.col(tags).isNotNull() & (F.size(tags) > 0),
                        reinsert_column(joined, F.col(tags))).otherwise(joined)
    out = [*keys, F.col(rank).alias("rank")]
    empty = F.col(is_empty) if is_empty else F.lit(False)
    out.append(F.when(empty, F.lit("")).otherwise(joined).alias("translation"))
    if words:
        flat = F.flatten(F.transform(ordered, unpacked_words))
        out.append(F.when(empty, F.array().cast("array<map<string,string>>"))
                   .otherwise(flat).alias("nbest_words"))
    return grouped.select(*out)


def collate_pieces(hyps: DataFrame, keys: Sequence[str] = ("doc_id", "line_no"), text: str = "translation",
                   words: str | None = None, postprocess: ColumnFn | None = None, tags: str | None = None,
                   n_best: int | None = None) -> DataFrame:
    """The unexpanded form of :func:`unwrap_pieces` (P8): one row per line, with
    ``translation ARRAY<STRING>`` by rank and, with ``words``, ``nbest_words``
    by rank, position and alternative.

    A rank that some piece lacks is left out, as there.  An empty line has
    ``n_best`` blanks (without it as many as the decoder gave).  A line whose
    pieces share no rank has two empty arrays.  One shuffle on ``keys``; the
    array holds the pieces and ranks of one line.
    """
    keys = list(keys)
    parts = F.struct("piece_no", "rank", F.col(text).alias("t"), *(packed_words(words) if words else []))
    df = (hyps.groupBy(*keys)
              .agg(F.collect_list(parts).alias("_parts"), F.max("n_pieces").alias("_need"), F.max("rank").alias("_last"),
                   F.first("is_empty").alias("is_empty"), *([F.first(tags).alias(tags)] if tags else [])))
    df = df.withColumn("_parts", F.array_sort("_parts", lambda l, r: (l["piece_no"] - r["piece_no"]).cast("int")))
    by_rank = F.transform(F.sequence(F.lit(0), F.col("_last")), lambda r: F.filter("_parts", lambda p: p["rank"] == r))
    df = df.withColumn("_ranks", F.filter(by_rank, lambda ps: F.size(ps) == F.col("_need")))

    def whole(ps):
        joined = F.array_join(F.transform(ps, lambda p: T.strip(p["t"])), " ")
        if postprocess is not None:
            joined = T.strip(postprocess(joined))
        if tags:
            from tessera.operators.placeholders import reinsert_column
            joined = reinsert_column(joined, F.coalesce(F.col(tags), F.array().cast("array<struct<placeholder:string,original:string>>")))
        return joined

    n = F.lit(n_best) if n_best is not None else F.size("_ranks")
    out = [*keys, F.when(F.col("is_empty"), F.array_repeat(F.lit(""), n)).otherwise(F.transform("_ranks", whole)).alias("translation")]
    if words:
        none = F.array().cast("array<map<string,string>>")
        out.append(F.when(F.col("is_empty"), F.array_repeat(none, n))
                   .otherwise(F.transform("_ranks", lambda ps: F.flatten(F.transform(ps, unpacked_words)))).alias("nbest_words"))
    return df.select(*out)
