"""Cross-tokenizer alignment: where the tokens of two tokenizers end together.

A text (with a space before it) is encoded by a byte-level BPE tokenizer (A) and
by a sentencepiece model with byte fallback (B).  *Coarse cuts* come from what
the libraries report: A's character offsets, turned into bytes, and the spans of
B's encoding proto.  They are refined where several tokens share a character: a
token of A whose offsets overlap the next one's ends inside a multibyte
character, and B's byte-fallback tokens have empty spans but for the last one.
Such ends are counted on from the last sure cut by the length of the tokens'
decoded bytes.  The decoded bytes of all tokens must be the text's, and the
refined ends must meet them; texts for which one tokenizer changes bytes have no
tokens.

Byte offsets where both have an end cut the tokens into groups; the two tokens
that end there are linked.  How often the corpus links a pair of ids, and
whether another A id is linked to the pair's B id more often, is counted by
Spark over all documents and joined back.

*Words.*  Neither tokenizer's tokens reach across a space that follows a
character other than a space and precedes one that is not white space (A's
pattern cuts there; B has no piece with a space inside, which is checked).  So a
text is cut at such spaces and a part met before, up to a number of parts per
worker, is not encoded again; new parts are encoded many at a time.
"""

from __future__ import annotations

import functools
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged
from tessera.llm.packing import batches_of

PARTS_KEPT = 250_000  # of each of two generations
PART_LENGTH = 64  # characters of a part that is kept
JOINED = 2000
BROADCAST_PAIRS = 1 << 21  # id pairs (24 bytes each) that may be broadcast; more are joined by a shuffle
SPACE = "▁"
#: a space after another character than a space and before one that is no white space
CUT = re.compile(r"(?<! ) (?=[^\s᠎])")
ODD = re.compile(r"  | $|^ | [\s᠎]")


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the characters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def sizes_of(text: str) -> np.ndarray:
    """UTF-8 bytes of each character."""
    c = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return 1 + (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF)


def refined(ends: np.ndarray, sure: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Coarse ends, and for those that are not sure the last sure one (or 0) and
    the lengths of the decoded bytes since."""
    if sure.all():
        return ends
    total = np.cumsum(lengths)
    at = np.maximum.accumulate(np.where(sure, np.arange(len(ends)), -1))
    base = np.where(at >= 0, ends[at] - total[at], 0)
    return np.where(sure, ends, base + total)


class Aligner:
    """Aligns texts; keeps the alignment of parts met before."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are plain text
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * (1 + max(self.a.get_vocab().values()))
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError(f"{path_b}: a piece has a space inside")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def ends_a(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and byte ends of A's tokens."""
        got = self.a.encode(text, add_special_tokens=False)
        ids = np.array(got.ids, np.int64)
        spans = np.fromiter(chain.from_iterable(got.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        place = np.concatenate(([0], np.cumsum(sizes_of(text))))
        sure = np.append(spans[1:, 0] >= spans[:-1, 1], True)[:len(ids)]
        return ids, refined(place[spans[:, 1]], sure, self.a_len[ids])

    def ends_b(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and byte ends of B's tokens, for the text without its first space."""
        try:
            proto = self.b.encode(text[1:], return_type="proto", num_threads=1)
        except TypeError:  # earlier releases of the library
            proto = self.b.encode(text[1:], out_type="immutable_proto")
        pieces = list(proto.pieces)
        ids, begins, ends = (np.array(x, np.int64) for x in ([p.id for p in pieces], [p.begin for p in pieces], [p.end for p in pieces]))
        sure = ends > begins
        if len(sure):
            sure[0] |= ends[0] == 0 and self.b_len[ids[0]] == 1  # the added space alone spans nothing
        return ids, refined(ends + 1, sure, self.b_len[ids])

    def align(self, text: str) -> tuple | None:
        """``a_ids, a_ends, b_ids, b_ends, cuts`` of a text that begins with a space,
        ``cuts`` being the ends that both have; None if a tokenizer changes bytes."""
        data = text.encode()
        a, a_ends = self.ends_a(text)
        b, b_ends = self.ends_b(text)
        if b"".join([self.a_bytes[i] for i in a.tolist()]) != data or b"".join([self.b_bytes[i] for i in b.tolist()]) != data:
            return None
        a_ends, b_ends = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])  # where spans and decoded bytes disagree, these hold
        return a, a_ends, b, b_ends, np.intersect1d(a_ends, b_ends, assume_unique=True)

    def groups(self, found: tuple, ends: list[int]) -> list[tuple[int, bytes, str]]:
        """For each part of the text, up to each of ``ends``: tokens of A + those of B << 32,
        linked pairs (A id << 32 | B id) and its groups as a string."""
        a, a_ends, b, b_ends, cuts = found
        ia, ib = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        pairs = a[ia] << 32 | b[ib]
        sa, sb = list(map(str, a.tolist())), list(map(str, b.tolist()))
        to_a, to_b = (ia + 1).tolist(), (ib + 1).tolist()
        texts = [f"{sa[i]}|{sb[k]}" if j - i == 1 == m - k else f"{','.join(sa[i:j])}|{','.join(sb[k:m])}"
                 for i, j, k, m in zip([0, *to_a], to_a, [0, *to_b], to_b)]
        last = np.searchsorted(cuts, ends)
        if (cuts[np.minimum(last, len(cuts) - 1)] != ends).any():
            raise ValueError("a part does not end with a token")
        out, g, na, nb = [], 0, 0, 0
        data = pairs.tobytes()
        for k in (last + 1).tolist():
            ea, eb = int(ia[k - 1]) + 1, int(ib[k - 1]) + 1
            out.append((ea - na + (eb - nb << 32), data[8 * g:8 * k], ";".join(texts[g:k])))
            g, na, nb = k, ea, eb
        return out

    def learn(self, parts: list[str]) -> dict[str, tuple | None]:
        """Parts (without their first space) by what :meth:`groups` says; None for those that change."""
        out: dict[str, tuple | None] = {}
        alone = [p for p in parts if not p or p[-1].isspace() or len(p) > PART_LENGTH]
        joined = [p for p in parts if p and not p[-1].isspace() and len(p) <= PART_LENGTH]
        for at in range(0, len(joined), JOINED):
            some = joined[at:at + JOINED]
            found = self.align(" " + " ".join(some))
            if found is None:
                alone += some
            else:
                ends = np.cumsum([1 + len(p.encode()) for p in some])
                out.update(zip(some, self.groups(found, ends)))
        for p in alone:
            found = self.align(" " + p)
            out[p] = found and self.groups(found, [len(p.encode()) + 1])[0]
        return out

    def parts(self, text: str) -> list[str]:
        """A text's parts, each without its first space."""
        if not ODD.search(text):
            return text.split(" ")
        parts = CUT.split(" " + text)
        return parts[1:] if parts[0] == "" else [parts[0][1:], *parts[1:]]

    def aligned(self, texts: list[str]) -> list[tuple[int, bytes, str] | None]:
        """For each text its counts, pairs and groups; None without tokens."""
        cut = [self.parts(t) if t else [] for t in texts]
        if len(self.young) >= PARTS_KEPT:  # parts not met in a while are forgotten
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = set().union(*cut).difference(young)
        again = [p for p in new if p in old]
        young.update({p: old[p] for p in again})
        new.difference_update(again)
        fresh = self.learn(list(new))
        young.update(fresh)
        out = []
        for text, parts in zip(texts, cut):
            if not parts:
                out.append(None)
                continue
            values = [young[p] for p in parts]
            if None in values:  # the text as a whole decides
                found = self.align(" " + text)
                out.append(found and self.groups(found, [len(text.encode()) + 1])[0])
                continue
            out.append((sum([v[0] for v in values]), b"".join([v[1] for v in values]), ";".join([v[2] for v in values])))
        for p in fresh:
            if len(p) > PART_LENGTH:  # long ones hardly come again
                del young[p]
        return out


@functools.lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def groups_of(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, groups, pairs, counts`` of every row: the numbers
    of tokens and groups, the groups as ``a1,a2|b1;a3|b2,b3``, the distinct linked
    pairs (A id << 32 | B id) and how often the document links each."""
    id_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        own = aligner(path_a, path_b)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for at, end in batches_of(texts):
                found = own.aligned(texts[at:end])
                n = [f[0] if f else 0 for f in found]
                links = [np.frombuffer(f[1], np.int64) if f else np.empty(0, np.int64) for f in found]
                distinct = [np.unique(x, return_counts=True) for x in links]
                edges = pa.array(np.concatenate(([0], np.cumsum([len(d[0]) for d in distinct]))), pa.int32())
                lists = [pa.ListArray.from_arrays(edges, pa.array(np.concatenate([d[k] for d in distinct]), kind))
                         for k, kind in ((0, pa.int64()), (1, pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array([x & 0xFFFFFFFF for x in n], pa.int64()), pa.array([x >> 32 for x in n], pa.int64()),
                     pa.array([len(x) for x in links], pa.int64()), pa.array([f[2] if f else "" for f in found], pa.string()), *lists],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "counts"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_a long, n_b long, n_groups long, groups string, pairs array<long>, counts array<long>")


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair, count, best`` from ``pairs, counts`` of documents: links of each id pair in
    the corpus, and 1 if no A id is linked to its B id more often, else 0."""
    places = linked.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    counts = staged(places.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pairs")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return counts.join(top, "b").select("pair", "count", (F.col("count") == F.col("top")).cast("long").alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", keep_groups: bool = True,
          limit: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256`` and, if ``keep_groups``, ``groups``; see :func:`groups_of`.

    ``n_best`` counts the links whose pair no other A id beats for its B id, in
    the whole corpus; ``count_sum`` adds up the corpus counts of all links.  Null
    and empty texts, and those whose bytes one of the tokenizers changes, have no
    tokens: zeros and an empty string.  Rows with a null id and repeated rows
    count like others.  A table of up to ``limit`` pairs is broadcast, a larger
    one joined by a shuffle, whose hot pairs AQE splits.  An empty table gives an
    empty result; other columns are not read.
    """
    found = groups_of(docs, path_a, path_b, key, text)
    found = found.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)))
    if not keep_groups:
        found = found.drop("groups")
    found = staged(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    pairs = staged(pair_counts(found), "pair-counts")
    if pairs.count() <= limit:
        pairs = F.broadcast(pairs)
    links = found.select("row", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    sums = links.join(pairs, "pair").groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.col("n") * F.col("best")).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    out = found.drop("pairs", "counts").join(sums, F.col("row") == F.col("_row"), "left").drop("row", "_row")
    return out.withColumns({"n_links": F.col("n_groups"), "n_best": F.coalesce("n_best", F.lit(0)).cast("long"),
                            "count_sum": F.coalesce("count_sum", F.lit(0)).cast("long")})


def spans(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, a_ids, a_ends, b_ids, b_ends, cuts`` of every row: token ids, the bytes of
    space + text before each token's end, and the ends that both have; empty
    lists where a text has no tokens.  Edge cases as in :func:`align`."""
    id_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        own = aligner(path_a, path_b)
        for batch in batches:
            for at, t in enumerate(batch.column(1).to_pylist()):
                found = own.align(" " + t) if t else None
                lists = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in found or [np.empty(0, np.int64)] * 5]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), *lists], names=["doc_id", "a_ids", "a_ends", "b_ids", "b_ends", "cuts"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, a_ids array<long>, a_ends array<long>, b_ids array<long>, b_ends array<long>, cuts array<long>")
