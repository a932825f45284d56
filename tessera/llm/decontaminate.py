"""Benchmark decontamination: size-partitioned MinHash containment search.

Short test items are looked for inside documents of any length.  An item's
sketch is its bottom-k MinHash: the ``k`` smallest hashes of its shingle set.
How many of them a document must share depends on the set's size: if a document
holds at least ``threshold`` of an item's ``n`` shingles, it misses at most
``miss = n - ceil(threshold * n)`` of them, so with ``k = min(n, miss + HITS)``
it shares at least ``k - miss`` of the sketch.  Items are partitioned by ``n``
(powers of two), each partition with its own sketch size, and a document is
only looked up in partitions whose smallest item it could contain
(``ceil(threshold * smallest)`` shingles).  The bound holds for documents of
any size, so unlike MinHash banding, whose Jaccard threshold vanishes when one
set is thousands of times larger than the other, the search loses nothing of
what the shingles define.  Every candidate is verified by exact containment of
the shingles themselves.

An item of fewer than ``SHINGLE`` words is one shingle of all its words, and is
looked for among the document's runs of as many words; such runs are hashed only
where an item of that length is given.

A document's hashes are looked up in the sorted sketches, so a document costs as
much with many items as with few (times a logarithm).

Documents are never shuffled: distinct item texts go out in blocks of about
``BLOCK`` shingle hashes, one pass over the documents for each block; the ids of
the items with a text are joined to what was found.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import numbered, staged, without

SHINGLE = 5
THRESHOLD = 0.8
HITS = 2
BLOCK = 1 << 20
#: A-Z lower-cased; ASCII characters that are neither letters nor digits separate words
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def shingle_texts(words: list[bytes], size: int = SHINGLE) -> list[bytes]:
    """All shingles; of fewer words the whole sequence, of none nothing."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]


def word_numbers(joined: bytes, gaps: np.ndarray) -> np.ndarray:
    """A 64-bit number for each word of space-joined words, from prefix sums of
    its bytes weighted by their place (vectorised; equal words, equal numbers)."""
    data = np.frombuffer(joined, np.uint8).astype(np.uint64)
    starts = np.concatenate(([0], gaps + 1))
    at = np.arange(len(data), dtype=np.uint64) - np.repeat(starts, np.diff(np.concatenate((starts, [len(data) + 1])))).astype(np.uint64)[:len(data)]
    mixed = (data + np.uint64(1)) * (at * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed[gaps] = 0
    return np.add.reduceat(mixed, starts)


def numbers_of(words: list[bytes]) -> np.ndarray:
    """The number of each word, in order."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    return word_numbers(joined, np.flatnonzero(np.frombuffer(joined, np.uint8) == 32))


def run_hashes(numbers: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` words, in order."""
    m = len(numbers) - size + 1
    if m < 1:
        return np.empty(0, np.uint64)
    out = np.full(m, size, np.uint64)
    for k in range(size):
        out = (out ^ numbers[k:k + m]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


@dataclass(frozen=True)
class Item:
    """A test item: its number in the block, the words of its shingles, their set and hashes."""

    id: int
    size: int
    shingles: frozenset[bytes]
    hashes: np.ndarray

    def needed(self, threshold: float) -> int:
        return math.ceil(threshold * len(self.shingles) - 1e-9)


def read_items(texts: list[bytes], size: int = SHINGLE) -> list[Item]:
    items = []
    for i, words in enumerate(map(words_of, texts)):
        own = min(size, len(words))
        items.append(Item(i, own, frozenset(shingle_texts(words, size)), np.unique(run_hashes(numbers_of(words), own)) if own else np.empty(0, np.uint64)))
    return items


class Partitions:
    """Bottom-k sketches of a block of items, partitioned by set size and shingle length."""

    def __init__(self, items: list[Item], threshold: float = THRESHOLD, hits: int = HITS):
        self.items, self.threshold, self.parts = items, threshold, []
        by_size: dict[tuple[int, int], list[int]] = {}
        for i, item in enumerate(items):
            if len(item.hashes):
                by_size.setdefault((item.size, len(item.hashes).bit_length()), []).append(i)
        for (size, _), members in sorted(by_size.items()):
            least = min(items[i].needed(threshold) for i in members)
            hashes, owners, share = [], [], np.zeros(len(items), np.int64)
            for i in members:
                miss = len(items[i].shingles) - items[i].needed(threshold)
                sketch = items[i].hashes[:miss + hits]  # sorted: the smallest
                hashes.append(sketch)
                owners += [i] * len(sketch)
                share[i] = max(1, len(sketch) - miss)
            flat = np.concatenate(hashes)
            order = np.argsort(flat, kind="stable")
            self.parts.append((size, least, flat[order], np.array(owners)[order], share))
        self.sizes = sorted({p[0] for p in self.parts})

    def candidates(self, docs: dict[int, np.ndarray]) -> list[int]:
        """Items whose sketch shares enough of the distinct hashes, given by shingle length."""
        found = []
        for size, least, flat, owners, share in self.parts:
            doc = docs[size]
            if len(doc) < least:
                continue
            first = np.searchsorted(flat, doc)
            n = np.searchsorted(flat, doc, side="right") - first  # sketches that hold each hash
            at = np.flatnonzero(n)
            if len(at):
                n, first = n[at], first[at]
                places = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                own, hits = np.unique(owners[places], return_counts=True)
                found += own[hits >= share[own]].tolist()
        return found

    def matches(self, text: bytes) -> list[tuple[int, int]]:
        """``(item, shared shingles)`` of the items that the text contains, verified on the shingles."""
        words = words_of(text)
        numbers = numbers_of(words)
        cands = self.candidates({n: np.unique(run_hashes(numbers, n)) for n in self.sizes})
        if not cands:
            return []
        own = {n: {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)} for n in {self.items[i].size for i in cands}}
        shared = [(i, len(self.items[i].shingles & own[self.items[i].size])) for i in cands]
        return [(i, n) for i, n in shared if n >= self.items[i].needed(self.threshold)]


def item_blocks(items: DataFrame, key: str, text: str, block: int = BLOCK) -> tuple[DataFrame, list[DataFrame]]:
    """``id, t`` of the items, and their distinct texts in blocks of about ``block`` words each."""
    rows = staged(items.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).cast("binary").alias("t")), "items")
    texts = staged(rows.select("t").distinct().withColumn("n", F.octet_length("t")).withColumn("b", F.xxhash64("t")), "item-texts")
    total = texts.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(total / 4 / block))  # a word and its gap have two bytes at least, mostly more
    return rows, [texts.where(F.pmod("b", F.lit(blocks)) == i).select("t") for i in range(blocks)]


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
          item_text: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per document and test item it contains: ``doc_id, item_id,
    shared, shingles, containment`` (shared over all distinct shingles of the
    item, at least ``threshold``).

    Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z
    lower-cased; shingles are ``size`` words, of an item with fewer words all of them.
    Null and wordless texts contain nothing and are contained in nothing.
    Repeated documents and items each get their rows; rows with a null id are
    searched like others.  Empty tables give an empty result; other columns
    are not read.
    """
    id_type = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {id_type}, _t binary, shared int, shingles int"
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("t"))
    rows, blocks = item_blocks(items, item_key, item_text, block)
    found = None
    for part in blocks:
        texts = sorted(bytes(r["t"]) for r in part.collect())  # one block, distinct texts
        table = Partitions(read_items(texts, size), threshold)

        def run(batches, table=table, texts=texts):
            for batch in batches:
                out = [(d, texts[i], n, len(table.items[i].shingles))
                       for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t
                       for i, n in table.matches(t)]
                cols = list(zip(*out)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.binary()),
                     pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())], names=["doc_id", "_t", "shared", "shingles"])

        hits = source.mapInArrow(run, schema)
        found = hits if found is None else found.unionByName(hits)
    named = found.join(rows.select(F.col("id").alias("item_id"), F.col("t").alias("_item")), F.col("_t") == F.col("_item"))
    return named.select("doc_id", "item_id", "shared", "shingles", (F.col("shared") / F.col("shingles")).alias("containment"))


def drop_leaked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that contain a test item, told apart by a number
    of their own: other rows of a leaked row's id stay, leaked
    ones without an id go.  ``key`` is not read."""
    rows = numbered(docs)
    found = leaks(rows.select("row", F.col("doc").getField(text).alias("text")), items, "row", "text", **options)
    return without(rows, staged(found.select(F.col("doc_id").alias("row")).distinct(), "leaks"))
