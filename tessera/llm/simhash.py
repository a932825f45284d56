"""SimHash near-dedup with pigeonring filtering.

A 64-bit fingerprint is cut into five segments on a ring.  If two fingerprints
differ in at most four bits, then (pigeonring principle) some segment starts a
chain whose first segment has no differing bit, whose first two have at most
one, whose first three have at most two, and so on: cumulative differences stay
within the proportional budget ``l * 4 / 5``.  A chain of ``CHAIN`` segments is
made an equality key: the start segment, plus halves of the following segments
that the budget leaves untouched (with at most ``k`` differing bits in the
first ``k`` following segments, at least ``k`` of their ``2 k`` halves agree).
Fingerprints that share a key are compared chain by chain, then in full.

Equal fingerprints are one class before the search.  Dense groups need fewer
pairs: fingerprints that agree outside a slice of four bits lie within four
bits of each other, so each is linked to the smallest one of its slices, and
what these links connect is one group before the search.  A key whose
fingerprints are all of one group is not searched; of any other key, those
outside its largest group are compared with the rest, so pairs within a dense
group are not enumerated.  Keys get longer with the number of fingerprints.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import UPPER, LOWER, components, numbered, staged, without

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEGMENTS = 5
CHAIN = 3
LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 values of all word shingles, as a signed 64-bit number."""
    words = text.translate(LOWERED).split()  # bytes.split(): space, \\t \\n \\v \\f \\r
    n = len(words)
    if not n:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_digest  # 8 bytes, most significant first
    if n <= shingle:
        hashes = digest(joined, 42)
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts, ends = [0, *(gaps[:n - shingle] + 1).tolist()], [*gaps[shingle - 1:].tolist(), len(joined)]
        hashes = b"".join([digest(joined[s:e], 42) for s, e in zip(starts, ends)])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(rows), BLOCK):
        bits = np.unpackbits(rows[at:at + BLOCK], axis=1)
        whole = len(bits) // 255 * 255  # sums of at most 255 rows fit a byte
        counts += bits[:whole].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > len(rows)).view(">i8")[0])


def with_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``, one row per row of ``docs``; a null text counts as empty."""
    id_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fps = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {id_type}, fp long")


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def segment_masks(segments: int = SEGMENTS) -> list[int]:
    """Bit masks of the segments, as even as 64 bits allow."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def halves(mask: int) -> list[int]:
    bits = [i for i in range(BITS) if mask >> i & 1]
    cut = len(bits) // 2
    return [sum(1 << i for i in bits[:cut]), sum(1 << i for i in bits[cut:])]


def chain_keys(segments: int = SEGMENTS, chain: int = CHAIN) -> list[tuple[int, int]]:
    """``(start, mask)`` of every key: two fingerprints within ``segments - 1``
    bits agree on the mask of at least one key whose start has a valid chain."""
    masks = segment_masks(segments)
    keys = []
    for start in range(segments):
        parts = [h for k in range(1, chain) for h in halves(masks[(start + k) % segments])]
        for chosen in combinations(range(len(parts)), chain - 1):
            if all(sum(c < 2 * k for c in chosen) >= k for k in range(1, chain)):
                keys.append((start, masks[start] | sum(parts[c] for c in chosen)))
    return keys


def chain_for(n: int, segments: int = SEGMENTS) -> int:
    """Segments in a key for ``n`` fingerprints: the fewest with which 64 unrelated
    fingerprints or less share a key's value on average.  No link depends on it."""
    bits = min(m.bit_count() for m in segment_masks(segments))
    return next((c for c in range(CHAIN, segments) if n <= 64 << bits + (c - 1) * (bits // 2)), segments)


def chain_condition(start: int, x: str, segments: int = SEGMENTS, distance: int = DISTANCE) -> str:
    """SQL: cumulative differences of the ring chain from ``start`` within ``l * distance / segments``."""
    masks, mask, out = segment_masks(segments), 0, []
    for length in range(1, segments + 1):
        mask |= masks[(start + length - 1) % segments]
        out.append(f"bit_count({x} & {signed(mask)}L) <= {length * distance // segments}")
    return "(" + " and ".join(out) + ")"


def slice_roots(fps: DataFrame, width: int = DISTANCE) -> DataFrame:
    """``fp, root``: each fingerprint with the smallest one that agrees with it
    outside one slice of ``width`` bits (itself, if there is none).

    Both are within ``width`` bits of each other, so each is linked to its
    root, and no pair is enumerated; a group that agrees outside a slice has at
    most ``2 ** width`` fingerprints.
    """
    slices = [((1 << min(i + width, BITS)) - 1) ^ ((1 << i) - 1) for i in range(0, BITS, width)]
    keyed = fps.select("fp", F.posexplode(F.array(*[F.expr(f"fp & {signed(~s & (1 << 64) - 1)}L") for s in slices])).alias("slice", "rest"))
    return (keyed.select("fp", F.min("fp").over(Window.partitionBy("slice", "rest")).alias("root"))
                 .groupBy("fp").agg(F.min("root").alias("root")))


def search_links(classes: DataFrame, segments: int = SEGMENTS, distance: int = DISTANCE, chain: int = CHAIN) -> DataFrame:
    """All pairs ``a < b`` of ``classes(fp, root)`` with different roots within
    ``distance`` bits, each once: a pair counts at the first key that finds it."""
    x = "(a ^ b)"
    keys = chain_keys(segments, chain)
    first = "case " + " ".join(f"when {x} & {signed(m)}L = 0 and {chain_condition(s, x, segments, distance)} then {i}"
                               for i, (s, m) in enumerate(keys)) + " else -1 end"
    return (candidates(classes, segments, chain).where(f"bit_count({x}) <= {distance} and k = {first}")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def candidates(classes: DataFrame, segments: int = SEGMENTS, chain: int = CHAIN) -> DataFrame:
    """``k, a, b``: pairs of different roots that share the value of key ``k``, once a key.

    One of such a pair is outside the key's largest root, so only these are joined
    with the others; a value under which all have one root is left out before."""
    masks = F.array(*[F.expr(f"fp & {signed(m)}L") for _, m in chain_keys(segments, chain)])
    rows = classes.select("fp", "root", F.posexplode(masks).alias("k", "v"))
    mixed = (rows.groupBy("k", "v").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("k", "v"))
    rows = staged(rows.join(staged(mixed, "mixed"), ["k", "v"]), "searched")
    largest = (rows.groupBy("k", "v", "root").agg(F.count("*").alias("n")).groupBy("k", "v")
               .agg(F.max(F.struct("n", "root")).getField("root").alias("main")))
    rows = rows.join(largest, ["k", "v"])
    left = rows.where("root <> main").select("k", "v", F.col("fp").alias("a"), F.col("root").alias("ra"))
    right = rows.select("k", "v", F.col("fp").alias("b"), F.col("root").alias("rb"), "main")
    return left.join(right, ["k", "v"]).where("ra <> rb and (rb = main or a < b)").select("k", "a", "b")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    Two documents are linked if their fingerprints differ in at most
    ``distance`` bits; ``component_id`` is the smallest id that links reach.
    Texts without a word, null ones included, have fingerprint zero and are
    linked like any others.  Null ids take part in links but never name a
    component unless no other id is in it; repeated rows are all returned.
    An empty table gives an empty result; other columns are not read.
    """
    if distance >= SEGMENTS:
        raise ValueError(f"distance must be below the number of segments, {SEGMENTS}")
    fps = staged(with_fingerprints(docs, key, text, shingle), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = staged(slice_roots(classes, distance), "rooted")
    near = components(rooted.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    rooted = staged(rooted.select("fp").join(near.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", F.coalesce("root", "fp").alias("root")), "near")
    found = search_links(rooted, distance=distance, chain=chain_for(rooted.count()))
    links = found.unionByName(rooted.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    roots = components(links)
    named = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = staged(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    members = staged(named.join(least, "root").select("fp", "component_id"), "members")
    return (fps.join(members, "fp")
               .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                     distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row left per group of linked ones, the one with the
    smallest id; of rows that share it, or have none, exactly one.  Rows are
    told apart by a number of their own, so an id that is repeated with other
    texts takes nothing along, and rows without an id can be copies too."""
    rows = numbered(docs)
    known = F.col("doc").getField(key)
    named = F.struct(known.isNull().alias("no_id"), known.alias("id"), "row")  # the smallest names the group
    groups = near_groups(rows.select(named.alias("name"), F.col("doc").getField(text).alias("text")), "name", "text", shingle, distance)
    lost = groups.where(F.col("doc_id.row") != F.col("component_id.row")).select(F.col("doc_id.row").alias("row"))
    return without(rows, staged(lost, "lost"))
