"""Best-fit packing of documents into token sequences by bin completion.

Documents become token ids and are packed into as few sequences of ``capacity``
tokens as can be found.  Only longer documents are cut, into full pieces and a
rest; full pieces are sequences of their own.

*In a group* (a bounded number of pieces, one task) the sequences are found by
bin completion: the largest piece left is put into a new sequence, the
undominated fillings of the room around it are enumerated, the fullest first,
and each is a branch.  A filling is dominated if a piece left out could replace
one or several smaller ones of it, or just be added.  Branch and bound: the
incumbent is the best-fit decreasing solution, and a branch is pruned as soon as
the room it has wasted exceeds what a better solution may waste in all.  The
search stops at the lower bound (total tokens, and the bound that pairs large
pieces) or after ``NODES`` fillings, with the best solution so far.

*Between groups* nothing is lost to a group's last, half-empty sequences: the
least filled ones (holding at most a quarter of the group's pieces) are opened
again and their pieces meet those of other groups in the next round, until one
group is left.  Each round has at most a quarter of the pieces of the one
before; pieces are dealt to groups by a hash of their row number, so no key,
length or group of copies gathers in one task.
"""

from __future__ import annotations

import functools
import math
import os
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tessera.llm.common import staged

CAPACITY = 4096
END_ID = 1
GROUP = 8192  # pieces of a group, on average
NODES = 4000  # fillings that a group's search may try beyond one for each sequence
LEAVES = 64  # fillings enumerated around one piece; None: all of them
WORDS_KEPT = 400_000  # of each of two generations, a few hundred bytes each
JOINED = 2000  # words encoded in one call


#: characters that a word of Latin letters may have behind it, parted from it by the tokenizer
TAIL = ".,;:!?#$%&*"
#: a word of Latin letters, each of one character in either case, and the punctuation after it
LATIN = re.compile(rf"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([{TAIL}]*)")


class WordIds:
    """Ids of texts by a tokenizer that drops white space.

    Such a tokenizer looks at no character beyond a space, so the ids of a text
    are those of its words (here: cut at spaces and line feeds) one after the
    other, and a word met again needs no second encoding.  New words are encoded
    many at a time: Latin ones apart from the punctuation behind them, told apart
    by the mark of a word's end that the vocabulary has, others with one special
    token between them.
    """

    def __init__(self, path: str, kept: int = WORDS_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer, self.kept = Tokenizer.from_file(path), kept
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        if self.ids("a, b\nc") != [*self.ids("a"), *self.ids(","), *self.ids("b"), *self.ids("c")] or not self.special:
            raise ValueError(f"{path}: a tokenizer that drops white space, with a special token, is needed")
        self.parts = all(self.ids(f"a{c}") == [*self.ids("a"), *self.ids(c)] for c in TAIL)
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(1 + max(vocabulary.values()), bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.folds = all(self.ids(c) == self.ids(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÉÖØÞ")
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def marked(self, words: list[str]) -> None:
        """Encode words with a special token behind each."""
        mark, stop = next(iter(self.special.items()))
        plain = [w for w in words if not any(s in w for s in self.special)]
        for w in set(words).difference(plain):
            self.young[w] = np.array(self.ids(w), "<u4").tobytes()
        self.joined(plain, f" {mark} ", lambda ids: ids == stop, 0)

    def joined(self, words: list[str], between: str, is_end, own: int) -> list[str]:
        """Encode words with ``between`` behind each; ``is_end`` tells where one ends, ``own``
        is 1 if that id is its own.  Returns the words of calls with another number of ends."""
        parts, failed = [words[i:i + JOINED] for i in range(0, len(words), JOINED)], []
        for part, got in zip(parts, self.tokenizer.encode_batch_fast([between.join(p) + between for p in parts], add_special_tokens=False)):
            ids = np.array(got.ids, "<u4")
            ends = np.flatnonzero(is_end(ids))
            if len(ends) != len(part):
                failed += part
                continue
            data, at = ids.tobytes(), 0
            for w, end in zip(part, ends.tolist()):
                self.young[w], at = data[4 * at:4 * (end + own)], end + 1
        return failed

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet."""
        cut, other = [], []
        for w in words:
            m = LATIN.fullmatch(w)
            if m and (self.parts or not m[2]):
                core, tail = m.groups()
                cut.append((w, core.lower() if self.folds else core, tail))
            else:
                other.append(w)
        other += {t for _, _, t in cut}.difference(self.young).difference(self.old)
        latin = list({c for _, c, _ in cut}.difference(self.young).difference(self.old))
        other += self.joined(latin, " ", lambda ids: self.ends[ids], 1) if self.ends.any() else latin
        self.marked([w for w in set(other) if w not in self.young])
        for w, core, tail in cut:
            if w != core:
                self.young[w] = self.known(core) + self.known(tail)

    def known(self, word: str) -> bytes:
        return self.young[word] if word in self.young else self.old[word]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        # each distinct word is looked up once, its ids are copied to all its places in numpy
        cut = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = cut.flatten().dictionary_encode()
        words, place = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        if len(self.young) >= self.kept:  # words not met in a while are forgotten
            self.old, self.young = self.young, {"": b""}
        young, old = self.young, self.old
        own = list(map(young.get, words))
        new = [i for i, data in enumerate(own) if data is None]
        if old:
            young.update({words[i]: old[words[i]] for i in new if words[i] in old})
        self.learn([words[i] for i in new if words[i] not in young])
        for i in new:
            own[i] = young[words[i]]
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        ids, first = np.frombuffer(b"".join(own), "<u4"), np.cumsum(sizes) - sizes
        n = sizes[place]
        ends = np.concatenate(([0], np.cumsum(n)))
        data = ids[np.repeat(first[place] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        bounds = (4 * ends[cut.offsets.to_numpy() - cut.offsets[0].as_py()]).tolist()
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def batches_of(texts: list, size: int = 1 << 21):
    """Slices of ``texts`` of about ``size`` characters, one text at least."""
    at, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= size:
            yield at, i + 1
            at, n = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit) of
    every row: its ids and ``end_id``, cut after each ``capacity``."""
    id_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        encoder, end = word_ids(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in batches_of(texts):
                owner, piece, length, ids = [], [], [], []
                for k, data in enumerate(encoder.encode(texts[a:b])):
                    data += end
                    for n, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at:at + 4 * capacity]
                        owner.append(a + k)
                        piece.append(n)
                        length.append(len(part) // 4)
                        ids.append(part)
                number = np.array(piece, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner, pa.int32())), pa.array(number), pa.array(number.astype(np.int64) * capacity),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, piece int, start long, length long, ids binary")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece into the fullest sequence that has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some sequence has room r
    for x in sorted(lengths, reverse=True):
        fits = rooms >> x
        if fits:
            room = x + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(x)
        else:
            room, at = capacity, len(bins)
            bins.append([x])
        by_room.setdefault(room - x, []).append(at)
        rooms |= 1 << (room - x)
    return bins


def lower_bound(lengths: list[int], capacity: int) -> int:
    """No packing has fewer sequences: tokens over capacity; pieces of more than
    1/(k+1) of it, at most k of which share one; and for each limit the pieces that
    exclude each other with what the room beside them can't take."""
    x = np.sort(np.array(lengths, np.int64))
    sums = np.concatenate(([0], np.cumsum(x)))
    best = -(-int(sums[-1]) // capacity)
    half = int(np.searchsorted(x, capacity // 2, side="right"))
    k = np.arange(1, capacity + 1)
    best = max(best, int(np.max(-(-(len(x) - np.searchsorted(x, capacity // (k + 1), side="right")) // k))))
    for least in np.unique(x[:half]).tolist():
        alone = int(np.searchsorted(x, capacity - least, side="right"))  # from here: no room for ``least``
        at = int(np.searchsorted(x, least))
        room = (alone - half) * capacity - int(sums[alone] - sums[half])
        best = max(best, len(x) - half + max(0, -(-(int(sums[half] - sums[at]) - room) // capacity)))
    return max(best, len(x) - half)


def smeared(bits: int, width: int) -> int:
    """Bits shifted up by each of 0 to ``width``."""
    done = 0
    while done < width:
        step = min(done + 1, width - done)
        bits |= bits << step
        done += step
    return bits


def dominated(filling: list[int], left: int, room: int) -> bool:
    """Whether a piece left out (bits of ``left``) can take the place of one or several
    smaller ones of the filling, of several equal in sum, or be added to it."""
    none, one, more = 1, 0, 0  # sums of no, one and several pieces
    for x in filling:
        more |= (more | one) << x
        one |= 1 << x
    return bool((smeared(none | more, room) | (smeared(one, room - 1) << 1 if room else 0)) & left)


def fillings(counts: dict[int, int], lengths: int, room: int, waste: int, leaves: int | None) -> list[tuple[int, list[int]]]:
    """Undominated fillings of ``room`` that waste at most ``waste``, the fullest first:
    ``(waste, pieces)``.  ``lengths`` has a bit for each length with a count."""
    found, own, seen = [], [], 0

    def descend(room_left: int, top: int) -> bool:
        """Fillings with pieces of at most ``top`` more; false when enough are seen."""
        nonlocal seen
        free = lengths & ((1 << (min(room_left, top) + 1)) - 1)
        if not free & ~1:
            seen += 1
            if room_left <= waste:
                left = lengths
                for x in set(own):
                    if own.count(x) == counts[x]:
                        left &= ~(1 << x)
                if not dominated(own, left & ~1, room_left):
                    found.append((room_left, list(own)))
            return leaves is None or seen < leaves and sum(w == 0 for w, _ in found) < 4
        while free & ~1:
            x = free.bit_length() - 1
            free &= ~(1 << x)
            if own.count(x) < counts[x]:
                own.append(x)
                more = descend(room_left - x, x if own.count(x) < counts[x] else x - 1)
                own.pop()
                if not more:
                    return False
        # nothing more: a filling of its own only if what is left out does not fit, which dominance tells
        return True

    descend(room, room)
    return sorted(found, key=lambda f: (f[0], [-x for x in f[1]]))


def bin_completion(lengths: list[int], capacity: int, nodes: int | None = NODES, leaves: int | None = LEAVES) -> list[list[int]]:
    """Sequences as lists of lengths; the fewest possible when neither limit stops the search."""
    best = best_fit(lengths, capacity)
    bound, total = lower_bound(lengths, capacity), sum(lengths)
    if len(best) <= bound:
        return best
    counts: dict[int, int] = {}
    for x in lengths:
        counts[x] = counts.get(x, 0) + 1
    present = sum(1 << x for x in counts)
    limit = None if nodes is None else nodes + len(best)

    def take(bin_: list[int], sign: int) -> None:
        nonlocal present
        for x in bin_:
            counts[x] -= sign
            present = present | 1 << x if counts[x] else present & ~(1 << x)

    def branches(wasted: int):
        top = present.bit_length() - 1
        take([top], 1)
        found = fillings(counts, present, capacity - top, (len(best) - 1) * capacity - total - wasted, leaves)
        take([top], -1)
        return iter([(w, [top, *f]) for w, f in found])

    # a stack of open branchings; the sequences chosen so far and their waste
    chosen: list[list[int]] = []
    wastes = [0]
    stack = [branches(0)]
    tried = 0
    while stack and len(best) > bound and (limit is None or tried < limit):
        step = next(stack[-1], None)
        if step is None or wastes[-1] + step[0] > (len(best) - 1) * capacity - total:
            stack.pop()
            if chosen:
                take(chosen.pop(), -1)
                wastes.pop()
            continue
        tried += 1
        take(step[1], 1)
        chosen.append(step[1])
        wastes.append(wastes[-1] + step[0])
        if present:
            stack.append(branches(wastes[-1]))
        else:
            if len(chosen) < len(best):
                best = [list(b) for b in chosen]
            take(chosen.pop(), -1)
            wastes.pop()
    return best


def pack_group(rows: np.ndarray, lengths: np.ndarray, capacity: int, last: bool, nodes: int | None = NODES) -> pd.DataFrame:
    """``row, sequence_id, offset, closed`` of one group's pieces.  A sequence's id
    is its smallest row; unless it is the last round, its least filled sequences stay open."""
    order = np.lexsort((rows, lengths))
    rows, lengths = rows[order], lengths[order]
    bins = bin_completion(lengths.tolist(), capacity, nodes)
    # pieces of one length are alike: hand out rows in order
    start = {int(x): int(i) for x, i in zip(*np.unique(lengths, return_index=True))}
    bins.sort(key=sum)
    reopened, may = 0, 0 if last else len(rows) // 4
    out_row, out_bin, out_at, out_closed = [], [], [], []
    for b in bins:
        own = []
        for x in b:
            own.append(int(rows[start[x]]))
            start[x] += 1
        stays_open = sum(b) < capacity and reopened + len(b) <= may
        if stays_open:
            reopened += len(b)
        else:
            may = 0  # only the least filled ones
        at = 0
        for x, row in zip(b, own):
            out_row.append(row)
            out_bin.append(min(own))
            out_at.append(at)
            out_closed.append(not stays_open)
            at += x
    return pd.DataFrame({"row": np.array(out_row, np.int64), "sequence_id": np.array(out_bin, np.int64),
                         "offset": np.array(out_at, np.int64), "closed": np.array(out_closed, bool)})


def packer(capacity: int, last: bool, nodes: int | None):
    """Task: the pieces of one group, packed."""
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        return pack_group(frame["row"].to_numpy(), frame["length"].to_numpy(), capacity, last, nodes)
    return pack


def place(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, nodes: int | None = NODES) -> DataFrame:
    """``row, sequence_id, offset`` of every one of ``pieces(row, length)``; rows
    are distinct longs, lengths 1 to ``capacity``."""
    full = pieces.where(F.col("length") == capacity)
    placed = full.select("row", F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_, round_ = pieces.where(F.col("length") < capacity).select("row", "length"), 0
    while True:
        groups = max(1, math.ceil(open_.count() / group))
        last = groups == 1
        dealt = open_.groupBy(F.pmod(F.xxhash64("row", F.lit(round_)), F.lit(groups)).alias("g"))
        found = staged(dealt.applyInPandas(packer(capacity, last, nodes), "row long, sequence_id long, offset long, closed boolean"), "packed")
        placed = placed.unionByName(found.where("closed").drop("closed"))
        if last:
            return placed
        left = found.where("not closed").select(F.col("row").alias("_row"))
        open_ = staged(open_.join(left, F.col("row") == F.col("_row"), "left_semi"), "open")
        round_ += 1


def packed_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id",
                  text: str = "text", group: int = GROUP, keep_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset`` and, if ``keep_ids``, ``ids``.

    A null or empty text is the one token ``end_id``; rows with a null id and
    repeated rows are packed like any others.  Any number of pieces of one length
    is fine.  An empty table gives an empty result; other columns are not read.
    """
    pieces = token_pieces(docs, tokenizer, capacity, end_id, key, text).withColumn("ids_crc32", F.crc32("ids"))
    if not keep_ids:
        pieces = pieces.drop("ids")
    pieces = staged(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    placed = place(pieces, capacity, group).withColumnRenamed("row", "_row")
    return pieces.join(placed, F.col("row") == F.col("_row")).drop("row", "_row")


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id",
              text: str = "text", group: int = GROUP) -> DataFrame:
    """The packed sequences: ``sequence_id, length, ids array<int>, spans`` (offset, length,
    doc_id, start of each piece, in order).  A sequence's pieces meet in one
    group, of at most ``capacity`` tokens.  Edge cases as in :func:`packed_pieces`."""
    own = packed_pieces(docs, tokenizer, capacity, end_id, key, text, group)
    span = F.struct("offset", "length", "doc_id", "start")
    own = own.mapInArrow(_as_arrays, own.drop("ids").schema.add("ids", ArrayType(IntegerType())))
    grouped = own.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"),
                                             F.array_sort(F.collect_list(span)).alias("spans"))
    return grouped.select("sequence_id", "length", F.flatten(F.col("p.ids")).alias("ids"), "spans")


def _as_arrays(batches):
    """Task: the column ``ids`` as lists of numbers."""
    for batch in batches:
        ids = batch.column("ids")
        sizes = np.fromiter((len(x) // 4 for x in ids.to_pylist()), np.int64, len(ids))
        flat = np.frombuffer(b"".join(ids.to_pylist()), "<u4").astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(flat))
        rest = [n for n in batch.schema.names if n != "ids"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], lists], names=[*rest, "ids"])
