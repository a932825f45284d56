"""Subword segmentation of a corpus by merges.

The reference calls a BPE library line by line with a model file it does not
ship.  Here (Sennrich et al. 2016):

* ``learn_merges`` (N2): word types and pair counts are built by one aggregation
  each.  A step merges several pairs at once, namely as many of the most frequent
  ones as cannot influence each other (see ``independent``), and changes the pair
  counts only by what the touched words lose and gain.  The driver loop runs
  over steps, never over data.
* ``encode_corpus`` (F34): lines are segmented where they are (``mapInPandas``;
  the merges travel with the function, their number is the model size, not the
  data size); a task segments a word once as long as it remembers it, so no
  token is shuffled.  With a vocabulary (S12) a unit that is not in it is taken
  apart again by the merge that made it, down to units that are, or characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.session import materialize

# End-of-word marker and subword continuation mark.
END_OF_WORD = "</w>"
CONTINUATION = "@@"
SPM_MARK = "\u2581"
WORDS_KEPT = 200_000     # words whose segmentation a task remembers
OPEN, CLOSE = "\u0001", "\u0002"   # around each symbol of a symbol string (never in text)
AHEAD = 64               # most frequent pairs that a step looks at
PASSES = 256             # merges up to which words are segmented many at once, a pass a merge
ONE_SYMBOL = "\U000F0000"  # first of the characters that stand for symbols then; words with these go one by one


def word_types(lines: DataFrame, text: str = "text") -> DataFrame:
    """``word, n, sym``: each symbol between OPEN and CLOSE, characters first, the last one + ``</w>``."""
    words = lines.select(F.explode(T.tokens(F.col(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    chars = F.regexp_extract_all(F.col("word"), F.lit("(?s)."), 0)
    sym = F.concat(F.lit(OPEN), F.array_join(chars, CLOSE + OPEN), F.lit(END_OF_WORD + CLOSE))
    return words.select("word", "n", sym.alias("sym"))


def symbols(sym) -> F.Column:
    """The symbols of a symbol string as an array."""
    return F.split(F.expr(f"substring({sym}, 2, length({sym}) - 2)"), CLOSE + OPEN, -1)


def pair_counts(types: DataFrame, sym: str = "sym", weight: str = "n") -> DataFrame:
    """``l, r, cnt``: neighbouring symbols, weighted."""
    t = types.select(F.col(weight).alias("n"), symbols(sym).alias("_s")).filter(F.size("_s") >= 2)
    pairs = F.transform(F.sequence(F.lit(1), F.size("_s") - 1),
                        lambda i: F.struct(F.get(F.col("_s"), i - 1).alias("l"), F.get(F.col("_s"), i).alias("r")))
    return (t.select("n", F.explode(pairs).alias("p"))
             .groupBy(F.col("p.l").alias("l"), F.col("p.r").alias("r")).agg(F.sum("n").alias("cnt")))


def independent(ranked: list[tuple[str, str, int]], complete: bool) -> list[tuple[str, str, int]]:
    """The first pairs of ``ranked`` (most frequent first) that one step may merge
    together, with the result of merging one at a time.

    Pairs without a common symbol leave each other's counts alone.  A pair that a
    merge makes new is at most as frequent as an old one that shares a symbol
    with a merged pair, so it cannot come before the pairs that are more frequent
    than the first one left out.  ``complete`` tells that no pair is missing.
    """
    used: set[str] = set()
    chosen = []
    for l, r, cnt in ranked:
        if used & {l, r}:
            break
        used |= {l, r}
        chosen.append((l, r, cnt))
    rest = ranked[len(chosen):]
    limit = rest[0][2] if rest else 0 if complete else ranked[-1][2]
    sure = [p for p in chosen if p[2] > limit]
    return sure or chosen[:1]


def learn_merges(lines: DataFrame, n_merges: int, text: str = "text", checkpoint_every: int = 5) -> DataFrame:
    """The first ``n_merges`` merges as ``rank, left, right, cnt``.

    Ties between equally frequent pairs go to the smallest (left, right)."""
    spark = lines.sparkSession
    types = materialize(word_types(lines, text))
    counts = materialize(pair_counts(types))
    merges: list[tuple[int, str, str, int]] = []
    steps, held = 0, None    # the counts of the last step, kept until the next one has read them
    while len(merges) < n_merges:
        top = [(x.l, x.r, int(x.cnt)) for x in counts.orderBy(F.col("cnt").desc(), "l", "r").limit(AHEAD).collect()]
        if not top or top[0][2] < 1:
            break
        batch = independent(top, len(top) < AHEAD)[:n_merges - len(merges)]
        merges += [(len(merges) + i, *p) for i, p in enumerate(batch)]
        after, touched = F.col("sym"), F.lit(False)
        for l, r, _ in batch:
            old = OPEN + l + CLOSE + OPEN + r + CLOSE
            touched = touched | F.contains(F.col("sym"), F.lit(old))
            after = F.replace(after, F.lit(old), F.lit(OPEN + l + r + CLOSE))
        changed = types.where(touched).select("n", "sym", after.alias("_after"))
        both = changed.select(F.explode(F.array(F.struct(F.col("sym"), (-F.col("n")).alias("n")),
                                                F.struct(F.col("_after").alias("sym"), F.col("n")))).alias("x")).select("x.*")
        if held is not None:
            held.unpersist()
        held, counts = counts, counts.unionByName(pair_counts(both)).groupBy("l", "r").agg(F.sum("cnt").alias("cnt")).where("cnt > 0")
        types = types.withColumn("sym", after)
        steps += 1
        if steps % checkpoint_every == 0:
            types, counts = materialize(types), materialize(counts)
        else:
            counts = counts.persist()
    for kept in (held, counts):
        if kept is not None:
            kept.unpersist()
    return spark.createDataFrame(merges, "rank int, left string, right string, cnt long")


def segment_word(word: str, ranks: dict) -> list[str]:
    """Apply merges to one word: repeatedly merge the lowest-ranked adjacent pair."""
    syms = list(word[:-1]) + [word[-1] + END_OF_WORD] if word else []
    while len(syms) > 1:
        best = None
        for i in range(len(syms) - 1):
            r = ranks.get((syms[i], syms[i + 1]))
            if r is not None and (best is None or r < best[0]):
                best = (r, i)
        if best is None:
            break
        r, _ = best
        pair = None
        out, i = [], 0
        while i < len(syms):
            if i < len(syms) - 1 and ranks.get((syms[i], syms[i + 1])) == r:
                pair = syms[i] + syms[i + 1]
                out.append(pair)
                i += 2
            else:
                out.append(syms[i])
                i += 1
        syms = out
    if syms and syms[-1].endswith(END_OF_WORD):
        syms[-1] = syms[-1][: -len(END_OF_WORD)]
    return [s for s in syms if s]


def segment_words(words: list[str], ranks: dict) -> list[list[str]]:
    """:func:`segment_word` of many words: one text with a character for each symbol,
    over which the merges go in their order, each in one pass.

    A merge can make a symbol that an earlier merge takes (one spelling made in
    two ways); after such a merge the passes start again at that earlier one,
    as every word takes its lowest-ranked pair next."""
    order = sorted(ranks, key=ranks.get)
    finals = {w[-1:] for w in words}
    free = ONE_SYMBOL <= max(map(max, filter(None, ["".join(words), *(l + r for l, r in order)])), default="")
    if len(order) > PASSES or len(finals) > PASSES ** 2 // 2 or free or "" in finals or "\n" in "".join(words):
        return [segment_word(w, ranks) for w in words]
    codes: dict[str, str] = {}

    def code(symbol: str) -> str:
        return symbol if len(symbol) == 1 else codes.setdefault(symbol, chr(ord(ONE_SYMBOL) + len(codes)))

    made = [l + r for l, r in order]
    again = [min((k for k in range(i) if made[i] in order[k]), default=i + 1) for i in range(len(order))]
    steps = [(code(l) + code(r), code(l + r)) for l, r in order]
    end = {c: code(c + END_OF_WORD) for c in finals}
    text = "\n".join([w[:-1] + end[w[-1]] for w in words])
    i = 0
    while i < len(steps):
        after = text.replace(*steps[i])
        i = again[i] if len(after) < len(text) else i + 1
        text = after
    symbols_ = {c: s for s, c in codes.items()}
    out = [[symbols_.get(c, c) for c in w] for w in text.split("\n")] if words else []
    for parts in out:
        parts[-1] = parts[-1][:-len(END_OF_WORD)]
    return out


def unmerge(units: list[str], made_of: dict, known: set[str]) -> list[str]:
    """Units (of one word, in order) that are not ``known`` are replaced by the
    two they were merged from, and those again, down to known units or
    characters.  Units before a word's end are looked up with the continuation mark."""
    def split(unit: str, final: bool) -> list[str]:
        shown = unit if final else unit + CONTINUATION
        pair = made_of.get(unit + END_OF_WORD if final else unit)
        if shown in known or pair is None:
            return [unit]
        left, right = pair
        return [*split(left, False), *split(right[:-len(END_OF_WORD)] if final else right, final)]
    return [u for i, unit in enumerate(units) for u in split(unit, i == len(units) - 1)]


def encode_corpus(lines: DataFrame, merges: DataFrame, keys=("doc_id", "line_no"), text: str = "text",
                  style: str = "bpe", vocab: DataFrame | None = None, threshold: int = 1) -> DataFrame:
    """``keys…, text`` with every token segmented, line by line and without
    a shuffle; a task remembers the segmentation of ``WORDS_KEPT`` words.

    ``style="bpe"``: ``sub@@ sub@@ sub``; ``style="spm"``: ``▁sub sub sub``
    (merges written with a word-start mark).  ``vocab(token, n)`` (S12, as
    ``read_vocab`` gives it) allows only units that occur ``threshold`` times;
    see :func:`unmerge`.  Merges and vocabulary are of the model's size."""
    keys = list(keys)
    ranks, made_of = {}, {}
    for r in merges.orderBy("rank").collect():
        ranks.setdefault((r.left, r.right), r.rank)
        made_of.setdefault(r.left + r.right, (r.left, r.right))
    known = None if vocab is None else {r.token for r in vocab.where(F.col("n") >= threshold).select("token").collect()}

    def segment(batches):
        seen: dict[str, str] = {}
        for pdf in batches:
            words = [line.split(" ") if line else [] for line in pdf[text]]
            distinct = set().union(*words)
            new = list(distinct.difference(seen))
            if len(seen) + len(new) > WORDS_KEPT:
                seen.clear()
                new = list(distinct)
            seen.update(zip(new, map(encoded, segment_words(new, ranks))))
            pdf[text] = [" ".join([seen[w] for w in line]) for line in words]
            yield pdf

    def encoded(parts: list[str]) -> str:
        if known is not None:
            parts = unmerge(parts, made_of, known)
        return SPM_MARK + " ".join(parts) if style == "spm" else f"{CONTINUATION} ".join(parts)

    rows = lines.select(*keys, F.array_join(T.tokens(F.col(text)), " ").alias(text))
    return rows.mapInPandas(segment, rows.schema)


def unit_counts(encoded: DataFrame, text: str = "text") -> DataFrame:
    """``token, n``: the vocabulary of a segmented corpus (units as written, with their marks)."""
    units = encoded.select(F.explode(F.split(F.col(text), " ")).alias("token")).where("token <> ''")
    return units.groupBy("token").agg(F.count("*").alias("n"))
