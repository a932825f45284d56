"""Suffix-array dedup: repeated byte strings by a distributed difference-cover algorithm.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere is
removed.  A suffix array over all bytes would be many times the corpus, so the
text is first reduced without losing a match:

1. *Candidates.*  Each window of ``LENGTH`` bytes has the k-gram of smallest
   hash in it as its mark.  Equal windows have equal marks, so only windows
   whose mark occurs twice in the corpus (of distinct texts) can be repeated.
   The runs of such windows are the regions; a text that has copies is repeated
   as a whole.
2. *Reduced string.*  Within a region, marks of short windows are anchors, and
   the bytes from one anchor to the next (and the k-gram after it) a symbol.
   Anchors are chosen by content alone, so a repeated passage is a repeated run
   of symbols.

On the reduced string the suffix array method runs as Spark jobs:

3. *Sort sampled triples.*  Suffixes at symbols 1 and 2 mod 3 (the difference
   cover) are named by sorting their triples of symbols.
4. *Recurse on names.*  Triples of names are sorted and named in turn, until a
   name that several suffixes share covers ``COVER`` bytes; a triple that occurs
   once needs no further name.
5. *Merge remaining suffixes.*  For any two suffixes a shift of at most two
   symbols makes both sampled, so two sets of keys, (symbol, name) and
   (symbol, symbol, name), give suffixes at 0 mod 3 the same key as all their equals.
6. *Find equal prefixes.*  Suffixes with equal keys share ``COVER`` bytes, which
   settles every window that starts at or just after their anchors.

No suffix order is built and no neighbours are compared: in steps 5 and 6 equal
keys are grouped, counted and joined back, because a key of very many suffixes
(one very common passage) would be one range of a sorted order, in one task.
Only equality counts; the sorts of the distinct keys and names change no row.

What is left are windows across the edges of repeated passages.  They, and one
member of each group of equal suffixes that has such a window as neighbour, are
compared by 128-bit hashes of their bytes, first runs of windows as a whole,
then window by window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import drop_staged, staged
from tessera.llm.url_filter import build_level

LENGTH = 400
MARK = 64  # bytes of a mark's k-gram
GRAM, SPAN = 16, 96  # bytes of an anchor's k-gram, k-gram starts in the windows whose minimum it is
CHUNK = 1 << 17  # bytes of small texts or regions handled at once
PIECE = 1 << 20  # windows handled at a time; longer texts and regions are cut with overlap
LEVELS = 7  # 3 ** 7 symbols cover any prefix that is asked for
FILTER_BITS = 1 << 27

_rng = np.random.default_rng(42)
BYTE = [_rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1) for _ in range(2)]
BASE = [0x9E3779B97F4A7C15, 0xD1B54A32D192ED03]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of a base and of its inverse modulo 2 ** 64."""
    if which not in _powers or len(_powers[which][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        both = []
        for base in (BASE[which], pow(BASE[which], -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            both.append(np.cumprod(row, dtype=np.uint64))
        _powers[which] = (both[0], both[1])
    return _powers[which]


class Hashes:
    """Hashes of substrings of a byte string, independent of where they stand."""

    def __init__(self, data: bytes, which: int = 0):
        b = np.frombuffer(data, np.uint8)
        up, self.down = powers(which, len(b) + 1)
        self.sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(BYTE[which][b] * up[:len(b)], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.mixed((self.sums[end] - self.sums[start]) * self.down[start], (np.asarray(end) - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        """The hashes of all substrings of one size, as ``of`` gives them."""
        n = len(self.sums) - size
        return self.mixed((self.sums[size:] - self.sums[:n]) * self.down[:n], np.array([size], np.uint64))

    @staticmethod
    def mixed(x: np.ndarray, size: np.ndarray) -> np.ndarray:
        x ^= size * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def minima(grams: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` neighbouring k-grams where the smallest starts
    (of equal ones the first)."""
    g = len(grams)
    low = np.uint64((1 << 24) - 1)
    keys = np.concatenate(((grams & ~low) | np.arange(g, dtype=np.uint64), np.full(-g % width, ~np.uint64(0)))).reshape(-1, width)
    ahead = np.minimum.accumulate(keys, axis=1).ravel()
    back = np.minimum.accumulate(keys[:, ::-1], axis=1)[:, ::-1].ravel()
    m = g - width + 1
    return (np.minimum(back[:m], ahead[width - 1:width - 1 + m]) & low).astype(np.int64)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of equal neighbours."""
    edge = np.flatnonzero(values[1:] != values[:-1])
    return np.concatenate(([0], edge + 1)), np.concatenate((edge, [len(values) - 1]))


def marks(text: bytes, length: int) -> tuple[list[int], list[int], list[int]]:
    """Hashes of the marks, and the first and last window of each."""
    gram = min(MARK, max(1, length // 4))
    hashes, first, last = [], [], []
    for at in range(0, len(text) - length + 1, PIECE):
        part = text[at:at + PIECE + length - 1]
        grams = Hashes(part).grams(gram)
        where = minima(grams, length - gram + 1)
        s, e = runs(where)
        hashes += grams[where[s]].view(np.int64).tolist()
        first += (s + at).tolist()
        last += (e + at).tolist()
    return hashes, first, last


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each start, as many as its count, one after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(counts.sum())


def chunks(offsets: np.ndarray):
    """Neighbouring texts of about ``CHUNK`` bytes together, at least one text: first and past the last."""
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        yield at, to
        at = to


def marks_of(data, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``marks`` of neighbouring texts at once, with the number of marks of each.

    A window inside a text has the same mark whatever stands beside the text."""
    sizes = np.diff(offsets)
    if len(sizes) == 1 and sizes[0] > PIECE:
        found = [np.array(x, np.int64) for x in marks(bytes(data), length)]
        return np.array([len(found[0])]), *found
    at = ragged(offsets[:-1], np.maximum(sizes - length + 1, 0))
    if not len(at):
        return np.zeros(len(sizes), np.int64), *[np.empty(0, np.int64)] * 3
    gram = min(MARK, max(1, length // 4))
    grams = Hashes(data).grams(gram)
    where = minima(grams, length - gram + 1)[at]
    s, e = runs(where)
    of = np.searchsorted(offsets, at[s], side="right") - 1
    return np.bincount(of, minlength=len(sizes)), grams[where[s]].view(np.int64), at[s] - offsets[of], at[e] - offsets[of]


def joined_windows(first: list[int], last: list[int]) -> list[tuple[int, int]]:
    """Runs of windows, neighbours joined, in pieces of at most ``PIECE``."""
    out: list[list[int]] = []
    for s, e in sorted(zip(first, last)):
        if out and s <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(a, min(a + PIECE - 1, e)) for s, e in out for a in range(s, e + 1, PIECE)]


def anchored(bodies: list[bytes], length: int) -> dict:
    """By region: anchors, symbols, and the first window of each anchor's run."""
    gram, span = min(GRAM, max(1, length // 16)), min(SPAN, max(1, length // 4))
    sizes = np.array([len(b) for b in bodies])
    offsets = np.append(0, np.cumsum(sizes))
    hashes = Hashes(b"".join(bodies))
    at = ragged(offsets[:-1], sizes - gram - span + 2)
    where = minima(hashes.grams(gram), span)[at]
    begins = runs(where)[0]
    anchors, first = where[begins], at[begins]
    of = np.searchsorted(offsets, first, side="right") - 1
    beside = of[1:] == of[:-1]
    symbols = hashes.of(anchors[:-1][beside], anchors[1:][beside] + gram).view(np.int64)
    windows = first <= offsets[of + 1] - length  # run k of windows has anchor k
    cut = lambda values, rows: np.split(values, np.cumsum(np.bincount(rows, minlength=len(sizes)))[:-1])
    return {"symbols": cut(symbols, of[1:][beside]), "anchors": cut((anchors - offsets[of]).astype(np.int32), of),
            "first": cut((first - offsets[of])[windows].astype(np.int32), of[windows])}


def cores(hashes: Hashes, anchors: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """By run of windows, whose first anchor is at ``at``, a hash of the anchored
    bytes that all of them hold and whose choice depends on nothing outside them."""
    gram, span = min(GRAM, max(1, length // 16)), min(SPAN, max(1, length // 4))
    end = np.searchsorted(anchors, at + length - 2 * span - gram, side="right") - 1
    return hashes.of(at, anchors[end] + gram).view(np.int64)


def cover(length: int) -> int:
    """Bytes that equal suffixes must share to settle the windows at their anchor."""
    return length + 2 * min(SPAN, max(1, length // 4))


def batch_of(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def packed(parts, kinds: dict, rows: int = 1 << 16, data: int = 1 << 24):
    """Record batches of about ``rows`` rows or ``data`` bytes from many small
    parts, each a dict of equally long columns (arrays or lists)."""
    held, n, size = [], 0, 0

    def batch():
        columns = {}
        for name, kind in kinds.items():
            values = [p[name] for p in held]
            flat = np.concatenate(values) if isinstance(values[0], np.ndarray) else [x for v in values for x in v]
            columns[name] = pa.array(flat, kind)
        return batch_of(columns)

    for part in parts:
        first = part[next(iter(kinds))]
        held.append(part)
        n += len(first)
        size += sum(len(x) for x in part.get("body", ()))
        if n >= rows or size >= data:
            yield batch()
            held, n, size = [], 0, 0
    if n:
        yield batch()


def bytes_of(column: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Offsets and bytes of a binary column without nulls."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    return at.astype(np.int64), memoryview(data) if data is not None else memoryview(b"")


LISTS = {"long": pa.list_(pa.int64()), "int": pa.list_(pa.int32())}


def scanned(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """``doc_id, digest, n_bytes`` of every row with the marks of its windows."""
    id_type = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("doc_id"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"),
                         F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))

    def run(batches):
        for batch in batches:
            offsets, data = bytes_of(batch.column(2))
            found = [marks_of(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], length) for a, b in chunks(offsets)]
            if found:
                counts, mark, first, last = (np.concatenate(x) for x in zip(*found))
                ends = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(v, t)) for v, t in ((mark, pa.int64()), (first, pa.int32()), (last, pa.int32()))]
                yield batch_of({"doc_id": batch.column(0), "digest": batch.column(1), "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                                "mark": lists[0], "first": lists[1], "last": lists[2]})

    return source.mapInArrow(run, f"doc_id {id_type}, digest string, n_bytes long, mark array<long>, first array<int>, last array<int>")


def candidate_windows(texts: DataFrame) -> DataFrame:
    """``doc, first, last``: the window runs of each distinct text whose mark occurs again."""
    places = texts.select("doc", F.explode(F.arrays_zip("mark", "first", "last")).alias("x")).select("doc", "x.*")
    repeated = places.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    return (places.join(staged(repeated, "marks"), "mark").groupBy("doc")
                  .agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last")))  # of one text


def regions_of(texts: DataFrame, length: int) -> DataFrame:
    """``rid, doc, start, body, symbols, anchors, first`` from ``doc, t, first, last``."""
    kinds = {"doc": pa.int64(), "start": pa.int64(), "body": pa.binary(), "symbols": LISTS["long"], "anchors": LISTS["int"],
             "first": LISTS["int"]}

    def columns(held):
        doc, start, body = (list(x) for x in zip(*held))
        return {"doc": doc, "start": start, "body": body} | anchored(body, length)

    def regions(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                doc, text, first, last = (c[at].as_py() for c in batch.columns)
                for s, e in joined_windows(first, last):
                    held.append((doc, s, text[s:e + length]))
                    size += e + length - s
                    if size >= CHUNK:
                        yield columns(held)
                        held, size = [], 0
        if held:
            yield columns(held)

    def run(batches):
        yield from packed(regions(batches), kinds, 4096)

    out = texts.select("doc", "t", "first", "last").mapInArrow(run, "doc long, start long, body binary, symbols array<long>, anchors array<int>, first array<int>")
    return staged(out.withColumn("rid", F.monotonically_increasing_id()), "regions")


TRIPLE = "rid long, i int, t0 long, t1 long, t2 long, cov int, ended boolean"
END = 0  # stands for a symbol or name after the region's last one; no name is 0


def triples(rid: int, at: np.ndarray, names: np.ndarray, covered: np.ndarray, size: int, gap: int, wanted: np.ndarray) -> dict:
    """Triples ``(x[i], x[i + gap], x[i + 2 gap])`` of the names ``x`` given at the
    sorted positions ``at``; those that meet a position without a name are left out."""
    parts, total, ended, keep = [names[wanted]], covered[wanted].copy(), np.zeros(wanted.sum(), bool), np.ones(wanted.sum(), bool)
    for k in (1, 2):
        want = at[wanted] + k * gap
        j = np.minimum(np.searchsorted(at, want), len(at) - 1)
        past, there = want >= size, at[j] == want
        keep &= past | there
        ended |= past
        parts.append(np.where(there, names[j], END))
        total += np.where(there, covered[j], 0)
    n = int(keep.sum())
    return {"rid": np.full(n, rid), "i": at[wanted][keep], "t0": parts[0][keep], "t1": parts[1][keep], "t2": parts[2][keep],
            "cov": np.minimum(total[keep], 1 << 30), "ended": ended[keep]}


def triple_batch(found: list[dict]) -> pa.RecordBatch:
    kinds = {"rid": pa.int64(), "i": pa.int32(), "t0": pa.int64(), "t1": pa.int64(), "t2": pa.int64(), "cov": pa.int32(), "ended": pa.bool_()}
    return batch_of({k: pa.array(np.concatenate([f[k] for f in found]) if found else [], t) for k, t in kinds.items()})


def sampled_triples(regions: DataFrame) -> DataFrame:
    """Triples of symbols at 1 and 2 mod 3."""
    def run(batches):
        for batch in batches:
            found = []
            for rid, symbols, anchors in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                c, n = symbols.values.to_numpy(), len(symbols)
                if n > 1:
                    at = np.arange(n)
                    found.append(triples(rid, at, c, np.diff(anchors.values.to_numpy()).astype(np.int64), n, 1, at % 3 != 0))
            yield triple_batch(found)
    return regions.select("rid", "symbols", "anchors").mapInArrow(run, TRIPLE)


def name_triples(found: DataFrame, level: int, need: int) -> DataFrame:
    """Names of the triples that occur more than once, in sorted order, at each place.

    Occurrences are counted before they are sorted and joined back, so a triple
    of very many places is one row on the sorted side."""
    names = (found.groupBy("t0", "t1", "t2").agg(F.count("*").alias("n"), F.min(F.struct("rid", "i")).alias("least")).where("n > 1")
                  .orderBy("t0", "t1", "t2")
                  .select("t0", "t1", "t2", "least", (F.monotonically_increasing_id() + F.lit((level << 58) + 1)).alias("name")))
    names = staged(names, "names")
    return found.join(names, ["t0", "t1", "t2"]).select(
        "rid", "i", "name", "cov", "ended", (F.col("cov") >= need).alias("done"),
        (F.struct("rid", "i") == F.col("least")).alias("leads"))


def named_suffixes(regions: DataFrame, length: int) -> DataFrame:
    """``rid, size, places(i, name, leads)``: sampled suffixes that share at least
    ``cover(length)`` bytes with another sampled one, by their final name."""
    need = cover(length)
    sizes = regions.select("rid", F.size("symbols").alias("size"))
    level, found = 1, name_triples(sampled_triples(regions), 1, need)
    state = None
    while True:
        places = found.select("rid", F.struct("i", "name", "cov", "ended", "done", "leads").alias("x"))
        if state is not None:
            places = places.unionByName(state.select("rid", F.explode("places").alias("x")).where("x.done"))
        grouped = places.groupBy("rid").agg(F.array_sort(F.collect_list("x")).alias("places"))  # of one region
        after = staged(grouped.join(sizes, "rid"), "names")
        if state is not None:
            drop_staged(state)
        state = after
        open_ = state.select(F.explode("places").alias("x")).where("not x.done and not x.ended").limit(1).count()
        if not open_ or level == LEVELS:
            break
        gap = 3 ** level
        level += 1

        def run(batches, gap=gap):
            for batch in batches:
                out = []
                for rid, size, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                    x = places.values
                    at, names = (x.field(f).to_numpy() for f in ("i", "name"))
                    cov = x.field("cov").to_numpy().astype(np.int64)
                    done, ended = (x.field(f).to_numpy(zero_copy_only=False) for f in ("done", "ended"))
                    if (~done & ~ended).any():
                        out.append(triples(rid, at.astype(np.int64), names, cov, size, gap, ~done & ~ended))
                yield triple_batch(out)

        found = name_triples(state.select("rid", "size", "places").mapInArrow(run, TRIPLE), level, need)
    return state


def equal_suffixes(regions: DataFrame, names: DataFrame) -> DataFrame:
    """``rid, i, leads``: every suffix that shares ``cover`` bytes with another; of
    each group of equal ones some lead."""
    table = names.select("rid", F.filter("places", lambda x: x["done"]).alias("places"))
    joined = table.join(regions.select("rid", "symbols"), "rid")

    kinds = {"o": pa.int32(), "k0": pa.int64(), "k1": pa.int64(), "k2": pa.int64(), "rid": pa.int64(), "i": pa.int32()}

    def keys(batches):
        for batch in batches:
            for rid, places, symbols in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                x, c = places.values, symbols.values.to_numpy()
                name = np.zeros(len(c) + 2, np.int64)
                name[x.field("i").to_numpy()] = x.field("name").to_numpy()
                i = np.arange(len(c))
                # order 1: 0 and 1 mod 3 by (symbol, name of the next); order 2: 0 and 2 mod 3 by two symbols and a name
                a = i[(i % 3 != 2) & (name[1:-1] != 0)]
                b = i[:-1][(i[:-1] % 3 != 1) & (name[2:-1] != 0)]
                n, m = len(a), len(b)
                yield {"o": np.repeat([1, 2], [n, m]), "k0": np.concatenate((c[a], c[b])),
                       "k1": np.concatenate((np.zeros(n, np.int64), c[b + 1])), "k2": np.concatenate((name[a + 1], name[b + 2])),
                       "rid": np.full(n + m, rid), "i": np.concatenate((a, b))}

    def run(batches):
        yield from packed(keys(batches), kinds)

    keyed = joined.select("rid", "places", "symbols").mapInArrow(run, "o int, k0 long, k1 long, k2 long, rid long, i int")
    keyed = staged(keyed, "keys")
    # equal keys are counted and joined back, not compared as neighbours of a sorted order: so a
    # key of very many suffixes is one row here and AQE splits the other side (the sort changes no row)
    beside = (keyed.groupBy("o", "k0", "k1", "k2").agg(F.count("*").alias("n"), F.min(F.struct("rid", "i")).alias("least"))
                   .where("n > 1").drop("n").orderBy("o", "k0", "k1", "k2"))
    merged = keyed.join(staged(beside, "beside"), ["o", "k0", "k1", "k2"]).select(
        "rid", "i", (F.struct("rid", "i") == F.col("least")).alias("leads"))
    sampled = table.select("rid", F.explode("places").alias("x")).select("rid", "x.i", "x.leads")
    return (merged.unionByName(sampled).groupBy("rid", "i").agg(F.max("leads").alias("leads"))
                  .groupBy("rid").agg(F.collect_list(F.struct("i", "leads")).alias("equal")))  # of one region


#: kind 0: open window runs, 1: settled ones of a leading suffix, 2: all settled ones, joined, and settled last windows of open ones
RUN = "kind int, core long, f0 long, f1 long, rid long, s int, e int"
RUN_KINDS = {"kind": pa.int32(), "core": pa.int64(), "f0": pa.int64(), "f1": pa.int64(), "rid": pa.int64(), "s": pa.int32(), "e": pa.int32()}


def window_runs(regions: DataFrame, equal: DataFrame, length: int) -> DataFrame:
    """Runs of windows with one first anchor: what equal suffixes settle, and the
    open rest with a hash of the anchored core and one of all bytes."""
    def found(batches):
        for batch in batches:
            offsets, data = bytes_of(batch.column(1))
            for a, b in chunks(offsets):
                part = batch.slice(a, b - a)
                yield of_regions(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], part)

    def flat(column):
        return column.flatten(), np.diff(column.offsets.to_numpy())

    def of_regions(data, offsets, part):
        rows = np.arange(part.num_rows)
        (anchors, n_anchors), (first, n_first) = flat(part.column(2)), flat(part.column(3))
        start = np.append(0, np.cumsum(n_anchors))  # of a region's anchors
        row = np.repeat(rows, n_first)
        anchors = anchors.to_numpy() + np.repeat(offsets[:-1], n_anchors)
        first = first.to_numpy() + offsets[row]
        ends = np.append(row[1:] != row[:-1], True)  # the last run of a region
        last = np.where(ends, offsets[row + 1] - length, np.append(first[1:], 0) - 1)
        full, leads = np.zeros(len(anchors), bool), np.zeros(len(anchors), bool)
        equal, n_equal = flat(part.column(4))
        if len(equal):
            n_equal = np.where(part.column(4).is_valid().to_numpy(zero_copy_only=False), n_equal, 0)
            i = np.repeat(start[:-1], n_equal) + equal.field("i").to_numpy()
            full[i], leads[i] = True, equal.field("leads").to_numpy(zero_copy_only=False)
        before = np.searchsorted(anchors, first, side="right") - 1
        known = before >= start[row]
        settled, leading = known & full[before], known & leads[before]
        opens = settled & ~(np.append(False, settled[:-1]) & ~np.append(True, ends[:-1]))
        closes = settled & (ends | ~np.append(settled[1:], False))
        spans = np.stack((np.flatnonzero(opens), np.flatnonzero(closes)))
        pick = np.flatnonzero(~settled | leading)
        hashes = Hashes(data), Hashes(data, 1)
        f0, f1 = (h.of(first[pick], last[pick] + length).view(np.int64) for h in hashes)
        begins = start[:-1][row] + np.arange(len(first)) - np.repeat(np.cumsum(n_first) - n_first, n_first)  # each run's anchor
        # an open run may end in the window that starts at its anchor: the anchor's equal suffixes settle that one alone
        own = np.flatnonzero(~settled & full[begins] & (anchors[begins] == last))
        done = np.concatenate((spans, np.stack((own, own))), axis=1)
        done_s, done_e = np.concatenate((first[spans[0]], last[own])), last[done[1]]
        none = np.zeros(done.shape[1], np.int64)
        base, joined = offsets[row[pick]], offsets[row[done[0]]]
        return {"kind": np.concatenate((settled[pick].astype(np.int64), none + 2)),
                "core": np.concatenate((cores(hashes[0], anchors, anchors[begins[pick]], length), none)),
                "f0": np.concatenate((f0, none)), "f1": np.concatenate((f1, none)),
                "rid": part.column(0).to_numpy()[np.concatenate((row[pick], row[done[0]]))],
                "s": np.concatenate((first[pick] - base, done_s - joined)),
                "e": np.concatenate((last[pick] - base, done_e - joined))}

    def run(batches):
        yield from packed(found(batches), RUN_KINDS)

    joined = regions.select("rid", "body", "anchors", "first").join(equal, "rid", "left")
    return joined.select("rid", "body", "anchors", "first", "equal").mapInArrow(run, RUN)


def settle_equal_runs(found: DataFrame) -> DataFrame:
    """Open runs whose bytes are those of another run are settled as a whole."""
    runs_ = found.where("kind < 2")
    equal = runs_.groupBy("f0", "f1").agg(F.count("*").alias("n"), F.min("kind").alias("k"), F.min(F.struct("rid", "s")).alias("leader"))
    equal = staged(equal.where("n > 1 and k = 0").select("f0", "f1", "leader"), "equal-runs")
    joined = runs_.join(equal, ["f0", "f1"], "left")
    leads = F.col("leader").isNull() | (F.struct("rid", "s") == F.col("leader"))
    same = F.col("leader").isNotNull() & (F.col("kind") == 0)
    rows = F.array(F.when(leads, F.struct(F.when(same, 1).otherwise(F.col("kind")).alias("kind"), "core", "rid", "s", "e")),
                   F.when(same, F.struct(F.lit(2).alias("kind"), "core", "rid", "s", "e")))
    out = joined.select(F.explode(F.array_compact(rows)).alias("x")).select("x.*")
    return out.unionByName(found.where("kind = 2").select("kind", "core", "rid", "s", "e"))


def open_windows(regions: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """``rid, p``: windows of open runs that are repeated.  Only runs whose core
    occurs again, beside an open one, are compared."""
    cores = (found.where("kind < 2").groupBy("core").agg(F.count("*").alias("n"), F.min("kind").alias("k")).where("n > 1 and k = 0").select("core"))
    wanted = found.where("kind < 2").join(staged(cores, "cores"), "core").groupBy("rid").agg(F.collect_list(F.struct("kind", "s", "e")).alias("x"))
    kinds = {"w0": pa.int64(), "w1": pa.int64(), "rid": pa.int64(), "p": pa.int32(), "open": pa.bool_()}

    def hashed(batches):
        for batch in batches:
            for rid, body, x in zip(*(c.to_pylist() for c in batch.columns)):
                s, e, kind = (np.array([r[f] for r in x]) for f in ("s", "e", "kind"))
                n = e - s + 1
                p = np.repeat(s - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                w = [Hashes(body, k).of(p, p + length).view(np.int64) for k in (0, 1)]
                yield {"w0": w[0], "w1": w[1], "rid": np.full(len(p), rid), "p": p, "open": np.repeat(kind == 0, n)}

    def run(batches):
        yield from packed(hashed(batches), kinds)

    windows = regions.select("rid", "body").join(wanted, "rid").select("rid", "body", "x").mapInArrow(
        run, "w0 long, w1 long, rid long, p int, open boolean")
    windows = staged(windows, "windows")
    again = windows.groupBy("w0", "w1").agg(F.count("*").alias("n"), F.max("open").alias("o")).where("n > 1 and o").select("w0", "w1")
    return windows.where("open").join(staged(again, "repeated"), ["w0", "w1"]).select("rid", "p")


def removed_spans(length: int):
    """Task: ``digest, n_removed, n_spans, kept_sha256, spans`` of texts with their removed windows."""
    def cut(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                digest, text, x = (c[at].as_py() for c in batch.columns)
                spans: list[list[int]] = []
                for s, e in sorted((r["s"], r["e"] + length) for r in x):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], e)
                    else:
                        spans.append([s, e])
                kept, done = hashlib.sha256(), 0
                for s, e in [*spans, [len(text), len(text)]]:
                    kept.update(text[done:s])
                    done = e
                yield {"digest": [digest], "n_removed": [sum(e - s for s, e in spans)], "n_spans": [len(spans)],
                       "kept_sha256": [kept.hexdigest()], "spans": [[f"{s}:{e}" for s, e in spans]]}

    def run(batches):
        yield from packed(cut(batches), {"digest": pa.string(), "n_removed": pa.int64(), "n_spans": pa.int64(),
                                         "kept_sha256": pa.string(), "spans": pa.list_(pa.string())}, 4096)
    return run


SPANS = "digest string, n_removed long, n_spans long, kept_sha256 string, spans array<string>"


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    Texts count as UTF-8 bytes, a null one as empty.  Removed is each byte
    covered by a ``length``-byte string that also starts anywhere else, in any
    row, repeated rows included; strings never cross documents.  ``spans`` lists
    the maximal removed runs as ``start:end`` (bytes, end exclusive).  Shorter
    texts lose nothing.  An empty table gives an empty result; other columns
    are not read.
    """
    rows = staged(scanned(docs, key, text, length), "scanned")
    texts = rows.where(F.col("n_bytes") >= length).groupBy("digest").agg(
        F.count("*").alias("copies"), F.first("mark").alias("mark"), F.first("first").alias("first"), F.first("last").alias("last"))
    texts = staged(texts.withColumn("doc", F.monotonically_increasing_id()), "texts")
    cands = staged(candidate_windows(texts).join(texts.select("doc", "digest"), "doc"), "candidates")

    # the texts of the candidates, one of each; a Bloom filter keeps most others out of the shuffle
    n = cands.count()
    level = build_level(cands.select(F.col("digest").alias("key")), n, max(0.02, 2.0 ** (-FILTER_BITS * 0.69 / max(n, 1))), 900)
    source = docs.select(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"), F.col(text).cast("binary").alias("t"),
                         level.words.scalar().alias("_w"))
    # inside exists() the digest is worked out once for all probes of the filter
    probed = F.exists(F.array("digest"), lambda d: level.holds(d, F.col("_w")))
    source = source.where(probed).groupBy("digest").agg(F.first("t").alias("t"))
    work = staged(source.join(cands, "digest"), "work")
    regions = regions_of(work, length)

    equal = staged(equal_suffixes(regions, named_suffixes(regions, length)), "equal")
    found = staged(settle_equal_runs(staged(window_runs(regions, equal, length), "window-runs")), "settled-runs")
    opened = open_windows(regions, found, length)
    gone = (found.where("kind = 2").select("rid", "s", "e").unionByName(opened.select("rid", F.col("p").alias("s"), F.col("p").alias("e")))
                 .join(regions.select("rid", "doc", "start"), "rid")
                 .groupBy("doc").agg(F.collect_list(F.struct((F.col("start") + F.col("s")).alias("s"), (F.col("start") + F.col("e")).alias("e"))).alias("x")))
    cut = staged(work.select("digest", "doc", "t").join(gone, "doc").select("digest", "t", "x").mapInArrow(removed_spans(length), SPANS), "cut")

    known = texts.select("digest", "copies").join(cut, "digest", "left").where("copies > 1 or n_removed is not null")
    known = staged(known.withColumnRenamed("digest", "_digest"), "known")
    whole = F.col("copies") > 1
    empty = hashlib.sha256(b"").hexdigest()
    joined = rows.select("doc_id", "digest", "n_bytes").join(known, F.col("digest") == F.col("_digest"), "left")
    return joined.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, empty).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(whole, F.array(F.concat(F.lit("0:"), F.col("n_bytes").cast("string")))).otherwise(
            F.coalesce("spans", F.array().cast("array<string>"))).alias("spans"))
