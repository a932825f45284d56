"""Decoder output parsing.

The reference reads the decoder's text output sequentially and keeps running
counters.  Here the raw output is a table ``raw_out(src_file, seq, line)``
with a dense 0-based ``seq`` per file, and every counter becomes a window or
a prefix sum:

* n-best lines (S8): one hypothesis per line, ``item = seq div n_best``.
* n-best-words blocks (S9): a hypothesis is a maximal run of non-blank lines
  (gaps and islands).  The island number is a prefix count of block starts,
  computed per bucket of ``bucket_lines`` lines plus a small per-bucket
  table, so a single huge output file is still processed by many tasks.
  Lines that lie together in the table are put together before they move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, MapType, StringType, StructField, StructType

from tessera.functions import text as T
from tessera.operators import wrap
from tessera.session import stored

# Fixed values of the decoder formats.
FIELD_SEP = " ||| "          # n-best line: id ||| text ||| features ||| score
WORD_SEP = "|||"             # n-best-words token line: token ||| alt score alt score …
END_TOKEN = "</s> "          # end-of-sentence token as it appears before the separator

DEFAULT_BUCKET_LINES = 1 << 20

#: White space of Unicode, U+0020 apart (Python's ``isspace`` also takes U+001C to U+001F).
OTHER_BLANKS = "".join(c for c in T.PY_WHITESPACE if c not in " \x1c\x1d\x1e\x1f")
_TO_SPACES = dict.fromkeys(map(ord, OTHER_BLANKS), " ")

LINES_KEPT = 200_000         # lines read before, kept by a task
FRAGMENT_SIZE = 1 << 22      # characters of a run after which it is cut


def parse_nbest(raw: DataFrame, n_best: int = 1, file: str = "src_file", seq: str = "seq",
                line: str = "line", n_items: int | None = None) -> DataFrame:
    """``id ||| text ||| F0 ||| score`` lines → ``file, item, rank, translation, features, score``.

    ``n_best`` consecutive lines form an item; a trailing incomplete group is
    dropped (as the reference does).  The id is the first field, features and
    score are the last two, and the text is all between, separators included.
    Lines with fewer fields are plain 1-best output: the line is the text and
    an item of its own, whatever ``n_best`` is (a file has lines of one kind).
    """
    parts = F.split(F.col(line), r" \|\|\| ", -1)
    n, has = F.size(parts), F.size(parts) >= 4
    hyps = raw.select(
        file, F.when(has, F.floor(F.col(seq) / n_best)).otherwise(F.col(seq)).cast("long").alias("item"),
        F.when(has, F.col(seq) % n_best).otherwise(0).cast("int").alias("rank"),
        F.when(has, F.array_join(F.slice(parts, F.lit(2), F.greatest(n - 3, F.lit(0))), FIELD_SEP)).otherwise(F.col(line)).alias("translation"),
        F.when(has, F.get(parts, n - 2)).alias("features"),
        F.when(has, F.get(parts, n - 1)).alias("score"))
    if n_items is not None:                       # L1: first n items of each file
        hyps = hyps.filter(F.col("item") < n_items)
    if n_best == 1:
        return hyps
    whole = F.count("score").over(Window.partitionBy(file, "item"))  # of one item: no file meets in one task
    return (hyps.withColumn("_n", whole).filter((F.col("_n") == n_best) | F.col("score").isNull()).drop("_n"))


def top_k(hyps: DataFrame, k: int, keys=("src_file", "item"), score: str = "score") -> DataFrame:
    """L2: best ``k`` hypotheses per item by score (descending), re-ranked from 0."""
    w = Window.partitionBy(*keys).orderBy(F.col(score).cast("double").desc(), F.col("rank"))
    return (hyps.withColumn("_r", F.row_number().over(w) - 1)
                .filter(F.col("_r") < k)
                .withColumn("rank", F.col("_r").cast("int")).drop("_r"))


def block_index(raw: DataFrame, file: str = "src_file", seq: str = "seq", line: str = "line",
                bucket_lines: int = DEFAULT_BUCKET_LINES) -> tuple[DataFrame, DataFrame]:
    """Number the islands of non-blank lines, 0-based and dense per file.

    Returns ``(rows, files)``: ``rows`` = raw rows with ``_nb`` (non-blank) and
    ``block`` (null on blank lines); ``files`` = one row per file with
    ``n_blocks`` and ``ends_open`` (the last line is not blank, so the last
    block was not closed by a blank line).
    """
    df = raw.select(file, seq, line, (T.strip(F.col(line)) != "").alias("_nb"),
                    F.floor(F.col(seq) / bucket_lines).cast("long").alias("_bkt"))
    wb = Window.partitionBy(file, "_bkt").orderBy(seq)
    df = df.withColumn("_prev_nb", F.lag("_nb").over(wb))
    inner_start = F.col("_nb") & F.col("_prev_nb").isNotNull() & ~F.col("_prev_nb")
    buckets = df.groupBy(file, "_bkt").agg(
        F.min_by("_nb", seq).alias("_first_nb"), F.max_by("_nb", seq).alias("_tail_nb"),
        F.count_if(inner_start).alias("_inner"))
    wf = Window.partitionBy(file).orderBy("_bkt")
    buckets = (buckets
               .withColumn("_seed_prev", F.coalesce(F.lag("_tail_nb").over(wf), F.lit(False)))
               .withColumn("_starts", F.col("_inner") + (F.col("_first_nb") & ~F.col("_seed_prev")).cast("long"))
               .withColumn("_offset", F.coalesce(F.sum("_starts").over(
                   wf.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    files = buckets.groupBy(file).agg(F.sum("_starts").alias("n_blocks"),
                                      F.max_by("_tail_nb", "_bkt").alias("ends_open"))
    # Per-file totals ride along with the small bucket table, so no row-level
    # join on ``file`` alone is needed (one huge file would land in one task).
    small = buckets.select(file, "_bkt", "_seed_prev", "_offset").join(files, file)
    start = F.col("_nb") & ~F.coalesce(F.col("_prev_nb"), F.col("_seed_prev"))
    # ``merge``: the row side is already hash-partitioned on (file, _bkt) by
    # the window above, so only the small table moves, and AQE cannot turn the
    # row side into a broadcast that would collapse the downstream parallelism.
    rows = (df.hint("merge").join(small, [file, "_bkt"])
              .withColumn("_start", start.cast("long"))
              .withColumn("_run", F.sum("_start").over(wb.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("block", F.when(F.col("_nb"), F.col("_offset") + F.col("_run") - 1))
              .drop("_bkt", "_prev_nb", "_seed_prev", "_offset", "_start", "_run"))
    return rows, files


def with_alternatives(df: DataFrame, rest: Column, out: str) -> DataFrame:
    """A4: ``alt score alt score …`` → ``MAP<alt, score>`` in column ``out``.

    Like a Python dict built in order: a repeated alternative keeps its first
    position and its last score.  Scores stay strings, as in the reference.
    Keys and values are projected as columns first (lambdas re-evaluate
    outer expressions per element); the lambda only runs when a key repeats,
    and no session setting (``mapKeyDedupPolicy``) is needed.
    """
    # fields in pairs, a last one without a partner left out; blanks are found without a regex
    df = df.withColumn("_f", F.array_remove(F.split(F.translate(rest, OTHER_BLANKS, " " * len(OTHER_BLANKS)), " ", -1), ""))
    df = (df.withColumn("_ak", F.filter("_f", lambda x, i: (i % 2 == 0) & (i < F.size("_f") - 1)))
            .withColumn("_av", F.filter("_f", lambda x, i: i % 2 == 1))).drop("_f")
    df = df.withColumn("_adk", F.array_distinct("_ak"))
    rk, rv = F.reverse("_ak"), F.reverse("_av")
    dedup = F.map_from_arrays("_adk", F.transform("_adk", lambda k: F.element_at(rv, F.array_position(rk, k).cast("int"))))
    return (df.withColumn(out, F.when(F.size("_adk") == F.size("_ak"), F.map_from_arrays("_ak", "_av"))
                          .otherwise(dedup))
              .drop("_ak", "_av", "_adk"))


def alternatives(rest: str) -> dict[str, str]:
    """:func:`with_alternatives` of one text."""
    blanks = rest if rest.isprintable() else rest.translate(_TO_SPACES)     # a space is the only printable blank
    fields = [x for x in blanks.split(" ") if x]
    return dict(zip(fields[::2], fields[1::2]))


def read_line(line: str | None) -> tuple | None:
    """A line of n-best-words output: ``None`` when blank, ``()`` a header, else its token
    field, the keys and the values of its map as texts, and the map itself when these can't
    tell it (no entry, or a mark within)."""
    s = (line or "").strip()
    if not s:
        return None
    if s.count(FIELD_SEP) == 3:
        return ()
    tok, _, rest = s.partition(WORD_SEP)
    found = alternatives(rest)                # its texts hold no space, the mark between positions
    odd = not found or wrap.BETWEEN_ENTRIES in rest
    return tok, wrap.BETWEEN_ENTRIES.join(found), wrap.BETWEEN_ENTRIES.join(found.values()), found if odd else None


def fragments(raw: DataFrame, n_best: int, file: str = "src_file", seq: str = "seq", line: str = "line") -> DataFrame:
    """Neighbouring lines of ``raw`` read and put together where they lie, without a shuffle.

    Rows whose ``seq`` follow each other in a partition are a segment.  A row is a run of a
    segment's non-blank lines (``seq`` of the first; ``gap``: a blank line is before it, null
    at the segment's start) with the tokens' ``text`` and the maps as in ``wrap.packed_words``, or
    (``blank``) the blank line at the segment's end.  In a segment that starts with the file,
    ``block`` counts the runs; ``whole`` marks those of an item that ends in the segment.
    Any cut of the file into segments gives the same blocks, fewer cuts only less to number.
    """
    kinds = {f.name: f.dataType for f in raw.schema}
    schema = StructType([StructField(file, kinds[file]), StructField("seq", LongType()), StructField("gap", BooleanType()),
                         StructField("blank", BooleanType()), StructField("block", LongType()), StructField("whole", BooleanType()),
                         StructField("text", StringType()), StructField("w", StringType()), StructField("v", StringType()),
                         StructField("m", ArrayType(MapType(StringType(), StringType())))])

    limit = FRAGMENT_SIZE

    def run(batches):
        import pyarrow as pa

        out, pending, seen = [], [], {}
        now = after = start = gap = block = None        # the segment's file and next line, the open run, its number
        parts, size, broken = None, 0, False

        def end_run(closed):
            nonlocal pending, parts, size, block, broken
            texts = [p for p in parts if p]
            row = [now, start, gap, False, block, False, "".join([p[0] for p in texts if p[0] != END_TOKEN]), None, None, None]
            if any(p[3] is not None for p in texts):
                row[9] = [list((p[3] if p[3] is not None else dict(zip(p[1].split(wrap.BETWEEN_ENTRIES), p[2].split(wrap.BETWEEN_ENTRIES)))).items())
                          for p in texts]
            elif texts:
                row[7], row[8] = (wrap.BETWEEN_POSITIONS.join([p[k] for p in texts]) for k in (1, 2))
            pending.append(row)
            parts, size = None, 0
            if closed and block is not None:
                block += 1
                if block % n_best == 0:
                    for r in pending:
                        r[5] = not broken
                    out.extend(pending)
                    pending, broken = [], False
            elif not closed or block is None:
                broken = True
                out.extend(pending)
                pending = []

        def end_segment():
            nonlocal pending, broken
            if after is not None and parts is None:
                out.append([now, after - 1, None, True, None, False, None, None, None, None])
            elif parts is not None:
                end_run(False)
            out.extend(pending)
            pending, broken = [], False

        def rows():
            kinds_ = [*file_kind, pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.string(),
                      pa.list_(pa.map_(pa.string(), pa.string()))]
            columns = list(zip(*out)) or [()] * len(kinds_)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds_)], names=schema.names)

        file_kind = None
        for batch in batches:
            file_kind = [batch.schema.field(0).type]
            lists = [batch.column(0).to_pylist(), *(batch.column(k).to_numpy(zero_copy_only=False).tolist() for k in (1, 2))]
            for f, s, text in zip(*lists):
                if s != after or f != now:
                    end_segment()
                    now, parts, before = f, None, None
                    block = 0 if s == 0 else None
                after = s + 1
                got = seen.get(text, 0)
                if got == 0:
                    got = read_line(text)
                    if text is not None and len(text) < 200:
                        if len(seen) >= LINES_KEPT:
                            seen.clear()
                        seen[text] = got
                if got is None:
                    if parts is not None:
                        end_run(True)
                    before = True
                    continue
                if parts is not None and size > limit:
                    end_run(False)
                if parts is None:
                    parts, start, gap = [], s, before
                before = False
                parts.append(got)
                size += len(text)
            yield rows()
            out.clear()
        end_segment()
        if out:
            yield rows()

    lines = raw.where(F.col(file).isNotNull() & F.col(seq).isNotNull()).select(file, F.col(seq).cast("long"), line)
    return lines.mapInArrow(run, schema)


def parse_nbest_words(raw: DataFrame, n_best: int = 1, file: str = "src_file", seq: str = "seq",
                      line: str = "line", n_items: int | None = None,
                      bucket_lines: int = DEFAULT_BUCKET_LINES) -> DataFrame:
    """N-best-words blocks → ``file, item, rank, translation, nbest_words``.

    Header lines (four ``' ||| '`` fields) are skipped; the text is the
    concatenation of the token fields in order without the ``</s> `` token;
    ``nbest_words`` holds one map per token line, ``</s>`` included.  A
    trailing incomplete n-best group is kept only when the output does not end
    with a blank line, like the reference's end-of-stream rule.

    Lines are read where they lie into :func:`fragments`, a stage table.  Fragments
    whose item is not told by their segment alone are numbered by
    :func:`block_index`, to which a run of lines is one line.  All move to their
    item as packed text and become maps there, so that maps are never shuffled;
    the result is partitioned by ``file, item``.
    """
    parts = stored(fragments(raw, n_best, file, seq, line), "fragments")
    at = F.struct(F.col("seq").alias("s"), F.when(F.col("blank"), F.lit("")).otherwise(F.lit("x")).alias("l"))
    ahead = F.struct((F.col("seq") - 1).alias("s"), F.lit("").alias("l"))
    marks = parts.select(file, F.explode(F.when(F.col("gap"), F.array(ahead, at)).otherwise(F.array(at))).alias("_l"))
    numbered, _ = block_index(marks.select(file, F.col("_l.s").alias("seq"), F.col("_l.l").alias("line")), file, "seq", "line", bucket_lines)
    packed = ["seq", "text", "w", "v", "m"]
    place = [F.floor(F.col("block") / n_best).cast("long").alias("item"), (F.col("block") % n_best).cast("int").alias("rank")]
    whole = parts.where("whole").select(file, *place, *packed)
    edges = (parts.where("not whole and not blank").select(file, *packed)
             .join(numbered.where("_nb").select(file, "seq", "block", "n_blocks", "ends_open"), [file, "seq"])
             .select(file, *place, *packed, "n_blocks", "ends_open")
             .filter((F.col("item") < F.floor(F.col("n_blocks") / n_best)) | F.col("ends_open"))
             .drop("n_blocks", "ends_open"))
    moved = whole.unionByName(edges)
    if n_items is not None:
        moved = moved.filter(F.col("item") < n_items)
    blocks = (moved.repartition(file, "item").groupBy(file, "item", "rank")
              .agg(F.collect_list(F.struct(*packed)).alias("_e")))
    # sort_array cannot order structs holding maps; a comparator on seq can.
    ordered = F.array_sort("_e", lambda l, r: F.signum(l["seq"] - r["seq"]).cast("int"))
    text = T.strip(F.array_join(F.transform(ordered, lambda e: e["text"]), ""))
    none = F.array().cast("array<map<string,string>>")
    maps = F.flatten(F.transform(ordered, lambda e: F.coalesce(wrap.unpacked_words(e), none)))
    return blocks.select(file, "item", "rank", text.alias("translation"), maps.alias("nbest_words"))


def canonical_words(words: Column) -> Column:
    """Order-free text form of ``nbest_words`` for comparisons and reports."""
    return F.array_join(F.transform(words, lambda m: F.array_join(F.array_sort(F.transform(
        F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), " ")), " | ")
