"""Unigram subword model with word-start marks (F35; Kudo 2018).

The reference encodes with a sentencepiece model whose pieces carry the mark
``▁`` of a word's start.  Such a model is learned and applied here:

* *Seed*: all substrings of the marked word types, weighted by the types' counts,
  in one aggregation; the ``seed_size`` with the largest count times length are
  kept, and every character.
* *Expectation*: the lattice of each distinct word (all its segmentations into
  seed pieces) is stored once; a task runs forward and backward over those of many
  words at once and adds up the expected number of each piece; Spark adds up the
  tasks.  *Maximisation*: a piece's probability is its share.
* *Pruning*: after some rounds the pieces are kept whose loss would cost the
  corpus most likelihood (their count in best segmentations, times what the best
  segmentation of the piece itself without it scores less), until ``size`` are left.
* *Encoding*: the best segmentation of each word (Viterbi), line by line, no shuffle;
  the new words of a batch are segmented at once, as arrays.

Word types are the only table a round reads; the driver holds the model
(``seed_size`` pieces at most), never data.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.session import materialize

MARK = "▁"
MAX_LENGTH = 16          # characters of a piece, the mark included
SHRINK = 0.75            # share of the pieces that a pruning keeps
ROUNDS = 2               # of expectation and maximisation before each pruning
UNKNOWN = 10.0           # log probability that an unknown character lies below the least piece
WORDS_KEPT = 200_000     # segmented before, kept by a task
LATTICE = (np.int64, np.int32, np.int32, np.int32, np.int32)   # numbers of the columns of stored lattices
AT_ONCE = 10_000         # words segmented at once


def word_counts(lines: DataFrame, text: str = "text") -> DataFrame:
    """``word, n``: distinct words, with the mark before them."""
    words = lines.select(F.explode(T.tokens(F.col(text))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return words.select(F.concat(F.lit(MARK), F.col("w")).alias("word"), "n")


def seed(words: DataFrame, seed_size: int, max_length: int = MAX_LENGTH) -> dict[str, float]:
    """Log probabilities of the seed pieces: every character, and the substrings
    that occur twice or more with the largest count times length."""
    n = F.length("word")
    starts = words.select("word", "n", F.explode(F.sequence(F.lit(1), n)).alias("i"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(max_length), n - F.col("i") + 1))
    parts = starts.select("n", F.explode(F.transform(sizes, lambda k: F.substr(F.col("word"), F.col("i"), k))).alias("piece"))
    counts = materialize(parts.groupBy("piece").agg(F.sum("n").alias("n")))
    score = F.col("n") * F.length("piece")
    longer = counts.where("length(piece) > 1 and n > 1").orderBy(score.desc(), "piece").limit(seed_size)
    kept = counts.where("length(piece) = 1").unionByName(longer).select("piece", score.cast("double").alias("s")).collect()  # model size
    total = sum(r.s for r in kept)
    return {r.piece: math.log(r.s / total) for r in kept}


def added(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def edges(word: str, pieces: dict[str, float], longest: int, unknown: float) -> list[list[tuple[int, float]]]:
    """By end position, the pieces that end there as ``(start, score)``; a character
    that is no piece is one with the score ``unknown``."""
    ends: list[list[tuple[int, float]]] = [[] for _ in range(len(word) + 1)]
    for i in range(len(word)):
        for j in range(i + 1, min(len(word), i + longest) + 1):
            score = pieces.get(word[i:j])
            if score is not None:
                ends[j].append((i, score))
            elif j == i + 1:
                ends[j].append((i, unknown))
    return ends


def expected(word: str, pieces: dict[str, float], longest: int, unknown: float) -> tuple[float, dict[str, float]]:
    """Log likelihood of a word over all its segmentations, and the expected number of each piece."""
    ends, n = edges(word, pieces, longest, unknown), len(word)
    forward = [0.0] + [-math.inf] * n
    for j in range(1, n + 1):
        for i, s in ends[j]:
            forward[j] = added(forward[j], forward[i] + s)
    backward = [-math.inf] * n + [0.0]
    found: dict[str, float] = {}
    for j in range(n, 0, -1):
        for i, s in ends[j]:
            backward[i] = added(backward[i], backward[j] + s)
            p = word[i:j]
            found[p] = found.get(p, 0.0) + math.exp(forward[i] + s + backward[j] - forward[n])
    return forward[n], found


def best(word: str, pieces: dict[str, float], longest: int, unknown: float, without: str | None = None) -> tuple[float, list[str]]:
    """The most probable segmentation and its score; of equal ones that with the
    longest last pieces.  ``without`` may not be used.  Unknown neighbours are one unit."""
    score, came = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
    for j, incoming in enumerate(edges(word, pieces, longest, unknown)):
        for i, s in incoming:
            if score[i] + s > score[j] and word[i:j] != without:
                score[j], came[j] = score[i] + s, i
    parts, j = [], len(word)
    while j:
        parts.append(word[came[j]:j])
        j = came[j]
    joined: list[str] = []
    for p in reversed(parts):
        if p not in pieces and joined and joined[-1] not in pieces:
            joined[-1] += p
        else:
            joined.append(p)
    return score[-1], joined


class Lattices:
    """The lattices of many words as arrays: an edge is a piece (its number, -1 for an
    unknown character) between two nodes; a word has a node before each character
    and one at its end, and its edges come by their end, then their start."""

    def __init__(self, lengths, edges_of, piece, end, size, scores):
        base = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        word = np.repeat(np.arange(len(lengths)), edges_of)
        score = scores[piece]                      # the last score is that of -1
        kept = score > -np.inf
        word, piece, score, end, start = word[kept], piece[kept], score[kept], end[kept], (end - size)[kept]
        self.first, self.last = base, base + lengths
        by_end = _order(end)
        self.word, self.piece, self.score, self.end, self.start = (x[by_end] for x in (word, piece, score, end, start))
        self.target, self.source = base[self.word] + self.end, base[self.word] + self.start
        by_start = _order(-start)                  # as the edges came, those of a word are together
        self._back = start[by_start], (base[word] + start)[by_start], (base[word] + end)[by_start], score[by_start]
        self.nodes = int((lengths + 1).sum())

    @staticmethod
    def _groups(position, node):
        """Slices of edges at one position in their words, each with its groups by node."""
        cuts = np.flatnonzero(np.diff(position)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(position)]):
            if a < b:
                own = node[a:b]
                at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                yield a, b, own[at], at, np.diff(np.append(at, b - a))

    def forward(self):
        """Log of the summed probability up to each node."""
        total = np.zeros(self.nodes)
        for a, b, nodes, at, sizes in self._groups(self.end, self.target):
            total[nodes] = _log_sums(total[self.source[a:b]] + self.score[a:b], at, sizes)
        return total

    def backward(self):
        """Log of the summed probability from each node to its word's end."""
        total = np.zeros(self.nodes)
        start, source, target, score = self._back
        for a, b, nodes, at, sizes in self._groups(start, source):
            total[nodes] = _log_sums(total[target[a:b]] + score[a:b], at, sizes)
        return total

    def best(self):
        """By node the edge through which the best segmentation reaches it, of equal ones the longest piece."""
        top, came = np.zeros(self.nodes), np.full(self.nodes, -1)
        for a, b, nodes, at, sizes in self._groups(self.end, self.target):
            x = top[self.source[a:b]] + self.score[a:b]
            top[nodes] = np.maximum.reduceat(x, at)
            came[nodes] = np.minimum.reduceat(np.where(x == np.repeat(top[nodes], sizes), np.arange(a, b), b), at)
        return came

    def paths(self):
        """The edges of the best segmentations, last ones first: steps of (words, edges)."""
        came, words, node = self.best(), np.arange(len(self.first)), self.last
        while len(words := words[open_ := node > self.first[words]]):
            edges_ = came[node[open_]]
            yield words, edges_
            node = self.source[edges_]


def _order(position):
    """Stable order of positions; those of ordinary words are sorted by their digits."""
    small = not len(position) or np.abs(position).max() < 1 << 15
    return np.argsort(position.astype(np.int16) if small else position, kind="stable")


def _log_sums(x, at, sizes):
    """log(sum(exp(x))) of each group."""
    top = np.maximum.reduceat(x, at)
    return top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, sizes)), at))


def edge_lists(word: str, ids: dict[str, int], longest: int) -> tuple[list[int], list[int], list[int]]:
    """Numbers, ends and lengths of the pieces in a word's lattice."""
    piece, end, size = [], [], []
    for j in range(1, len(word) + 1):
        for i in range(max(0, j - longest), j):
            p = ids.get(word[i:j], -1 if i + 1 == j else None)
            if p is not None:
                piece.append(p)
                end.append(j)
                size.append(j - i)
    return piece, end, size


class Trie:
    """The pieces by their characters: from a node (0 at first) and a character to the next
    node, as sorted arrays; ``number`` has the piece that ends at a node, or -1."""

    def __init__(self, pieces):
        self.chars = np.array(sorted({ord(c) for p in pieces for c in p}) or [-1])
        place, nodes, self.number = {c: k for k, c in enumerate(self.chars.tolist())}, {}, [-1]
        for k, p in enumerate(pieces):
            node = 0
            for c in p:
                key = node * len(place) + place[ord(c)]
                if key not in nodes:
                    nodes[key] = len(self.number)
                    self.number.append(-1)
                node = nodes[key]
            self.number[node] = k
        self.number, self.longest = np.array(self.number), max(map(len, pieces), default=1)
        self.keys = np.array(sorted(nodes) or [-1])
        self.to = np.array([nodes.get(k, 0) for k in self.keys.tolist()])

    def edges(self, words: list[str]):
        """:func:`edge_lists` of many words at once: the words' lengths and numbers of edges, then all numbers, ends and lengths."""
        lengths = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        base = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(words)), lengths)
        left = (base + lengths)[word] - np.arange(len(codes))
        char = np.searchsorted(self.chars, codes).clip(max=len(self.chars) - 1)
        char[self.chars[char] != codes] = -1
        at, node, single = np.arange(len(codes)), np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
        starts, sizes, pieces = [], [], []
        for k in range(self.longest):
            more = left[at] > k
            at, node = at[more], node[more]
            c = char[at + k]
            key = node * len(self.chars) + c
            found = np.searchsorted(self.keys, key).clip(max=len(self.keys) - 1)
            hit = (c >= 0) & (self.keys[found] == key)
            at, node = at[hit], self.to[found[hit]]
            whole = self.number[node] >= 0
            starts.append(at[whole])
            pieces.append(self.number[node[whole]])
            sizes.append(np.full(len(starts[-1]), k + 1))
            if k == 0:
                single[starts[0]] = True
        alone = np.flatnonzero(~single)
        start = np.concatenate([*starts, alone])
        size, piece = np.concatenate([*sizes, np.ones(len(alone), np.int64)]), np.concatenate([*pieces, np.full(len(alone), -1)])
        order = np.lexsort((start, start + size))
        start, size, piece = start[order], size[order], piece[order]
        return lengths, np.bincount(word[start], minlength=len(words)), piece, start + size - base[word[start]], size


def best_of_all(words: list[str], trie: Trie, scores) -> list[str]:
    """:func:`best` of many words without line breaks, each as its units with spaces between them."""
    lengths, edges_of, piece, end, size = trie.edges(words)
    lat, base = Lattices(lengths, edges_of, piece, end, size, scores), np.cumsum(lengths) - lengths
    starts, strange = np.zeros(lengths.sum(), bool), np.zeros(lengths.sum(), bool)
    for of, edges_ in lat.paths():
        at = base[of] + lat.start[edges_]
        starts[at], strange[at] = True, lat.piece[edges_] < 0
    starts[1:] &= ~(strange[1:] & strange[:-1])    # unknown neighbours are one unit
    starts[base] = True
    at = np.flatnonzero(starts)[1:]
    between = np.full(len(starts), ord(" "))
    between[base] = ord("\n")
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    return np.insert(codes, at, between[at]).astype("<u4").tobytes().decode("utf-32-le").split("\n")


def lattices(words: DataFrame, pieces: dict[str, float]) -> DataFrame:
    """``n, length, edges, piece, end``: of some thousand words a row, their counts, lengths and numbers
    of edges, and the edges of their lattices of ``pieces``, numbered in their order, as arrays of numbers."""
    trie = Trie(list(pieces))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths, edges_of, piece, end, _ = trie.edges(batch.column(0).to_pylist())
            n = batch.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in zip(
                (n, lengths, edges_of, piece, end), LATTICE)], names=["n", "length", "edges", "piece", "end"])

    return words.select("word", "n").mapInArrow(run, "n binary, length binary, edges binary, piece binary, end binary")


def counts_of(words: DataFrame, pieces: dict[str, float], stored: DataFrame | None = None,
              names: list[str] | None = None) -> tuple[float, dict[str, tuple[float, float]]]:
    """Log likelihood of the corpus, and by piece its expected count and its count in
    the best segmentations.  ``stored`` holds the words' :func:`lattices` of the
    pieces ``names``, of which ``pieces`` are some; else they are worked out here."""
    if stored is None:
        stored, names = lattices(words, pieces), list(pieces)
    unknown = min(pieces.values()) - UNKNOWN
    scores = np.array([*(pieces.get(p, unknown if len(p) == 1 else -np.inf) for p in names), unknown])

    sizes = np.array([*map(len, names), 1])

    def run(batches):
        total, all_, first = 0.0, np.zeros(len(scores)), np.zeros(len(scores))
        for row in (row for batch in batches for row in zip(*(batch.column(k) for k in range(5)))):
            n, lengths, edges_of, piece, end = (np.frombuffer(x.as_buffer(), t).astype(np.int64) for x, t in zip(row, LATTICE))
            n, lat = n.astype(float), Lattices(lengths, edges_of, piece, end, sizes[piece], scores)
            forward, backward = lat.forward(), lat.backward()
            likely = forward[lat.last]
            total += float(n @ likely)
            weight = n[lat.word] * np.exp(forward[lat.source] + lat.score + backward[lat.target] - likely[lat.word])
            all_ += np.bincount(lat.piece % len(scores), weight, len(scores))
            for of, edges_ in lat.paths():
                first += np.bincount(lat.piece[edges_] % len(scores), n[of], len(scores))
        at = np.flatnonzero(all_[:-1])
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1], pa.int32()), pa.array([*all_[at], total], pa.float64()),
                                          pa.array([*first[at], 0.0], pa.float64())], names=["piece", "expected", "best"])

    sums = stored.mapInArrow(run, "piece int, expected double, best double").groupBy("piece").agg(
        F.sum("expected").alias("e"), F.sum("best").alias("b")).collect()  # model size
    found = {names[r.piece] if r.piece >= 0 else None: (r.e, r.b) for r in sums}
    return found.pop(None, (0.0, 0.0))[0], {p: found.get(p, (0.0, 0.0)) for p in pieces}


def maximised(counts: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Each piece's share of the expected counts; longer ones expected less than half a
    time go, characters stay."""
    kept = {p: max(e, 1e-6) for p, (e, _) in counts.items() if len(p) == 1 or e >= 0.5}
    total = sum(kept.values())
    return {p: math.log(e / total) for p, e in kept.items()}


def pruned(pieces: dict[str, float], counts: dict[str, tuple[float, float]], size: int) -> dict[str, float]:
    """Characters, and of the longer pieces those whose loss would cost most, ``size`` in all."""
    longest, unknown = max(map(len, pieces)), min(pieces.values()) - UNKNOWN
    chars = {p: s for p, s in pieces.items() if len(p) == 1}
    loss = {p: counts.get(p, (0.0, 0.0))[1] * (s - best(p, pieces, longest, unknown, without=p)[0]) for p, s in pieces.items() if len(p) > 1}
    order = sorted(loss, key=lambda p: (-loss[p], p))[:max(0, size - len(chars))]
    return chars | {p: pieces[p] for p in order}


def learn(lines: DataFrame, size: int, text: str = "text", seed_size: int | None = None, max_length: int = MAX_LENGTH,
          report: list | None = None) -> DataFrame:
    """``piece, score`` of a model of ``size`` pieces (more only if there are more
    characters), most probable first; ``report`` gets the corpus's log likelihood
    at each expectation.  An empty corpus gives an empty model."""
    words = materialize(word_counts(lines, text))
    pieces = seed(words, seed_size or 10 * size, max_length)
    names = list(pieces)
    known = materialize(lattices(words, pieces)) if pieces else None
    while pieces:
        for _ in range(ROUNDS):
            logp, counts = counts_of(words, pieces, known, names)
            pieces = maximised(counts)
            if report is not None:
                report.append((len(counts), logp))
        if len(pieces) <= size or all(len(p) == 1 for p in pieces):
            break
        pieces = pruned(pieces, counts, max(size, int(SHRINK * len(pieces))))
    rows = sorted(pieces.items(), key=lambda x: (-x[1], x[0]))
    return lines.sparkSession.createDataFrame(rows, "piece string, score double")


def encode(lines: DataFrame, model: DataFrame, keys=("doc_id", "line_no"), text: str = "text") -> DataFrame:
    """``keys…, text`` with every word as its best pieces, space-joined; joining
    them and turning marks into spaces gives the words back (F32).  Characters
    that the model has not are units as they are.  The model travels with the function."""
    keys = list(keys)
    pieces = {r.piece: r.score for r in model.collect()}  # model size
    longest = max(map(len, pieces), default=1)
    unknown = min(pieces.values(), default=0.0) - UNKNOWN

    trie, scores = Trie(list(pieces)), np.array([*pieces.values(), unknown])

    def segment(batches):
        seen: dict[str, str] = {}
        for pdf in batches:
            words = [line.split(" ") if line else [] for line in pdf[text]]
            distinct = set().union(*words)
            new = list(distinct.difference(seen))
            if len(seen) + len(new) > WORDS_KEPT:
                seen.clear()
                new = list(distinct)
            for k in range(0, len(new), AT_ONCE):
                seen.update(zip(new[k:k + AT_ONCE], best_of_all([MARK + w for w in new[k:k + AT_ONCE]], trie, scores)))
            pdf[text] = [" ".join([seen[w] for w in line]) for line in words]
            yield pdf

    rows = lines.select(*keys, F.array_join(T.tokens(F.col(text)), " ").alias(text))
    return rows.mapInPandas(segment, rows.schema)
