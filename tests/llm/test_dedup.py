"""SimHash, exact and suffix-array dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, simhash, suffix_dedup
from tessera.llm.common import components
from tests.llm.helpers import WORDS, prose


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(ids, linked):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, d in enumerate(ids)}


def test_near_groups(spark):
    r = random.Random(4)
    docs = []
    for i in range(150):
        words = prose(i % 40, 120).split()
        for _ in range(i // 40):
            words[r.randrange(len(words))] = r.choice(WORDS)
        docs.append((1000 - i, " ".join(words).capitalize() if i % 3 else "\x0b".join(words)))
    docs += [(2000, None), (2001, ""), (2002, "a b"), (2003, "A  b\n")]
    got = simhash.near_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    fps = [brute_fingerprint(t) for _, t in docs]
    want = smallest_reachable([d for d, _ in docs], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    assert {x["doc_id"]: (x["fingerprint"], x["component_id"]) for x in got} == {d: (f"{f:016x}", want[d]) for (d, _), f in zip(docs, fps)}
    assert len(set(want.values())) < len(docs) - 20
    left = simhash.drop_near_copies(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x["doc_id"] for x in left} == set(want.values())


def test_dense_fingerprints_are_linked(spark):
    """Hundreds of fingerprints in one ball, and loose ones."""
    r = random.Random(5)
    centre = r.getrandbits(64)
    fps = [centre ^ sum(1 << b for b in r.sample(range(20), r.randint(0, 6))) for _ in range(400)] + [r.getrandbits(64) for _ in range(100)]
    fps = sorted(set(fps))
    table = spark.createDataFrame([(simhash.signed(f), simhash.signed(f)) for f in fps], "fp long, root long")
    links = {(x["a"], x["b"]) for x in simhash.search_links(table).collect()}
    want = {tuple(sorted((simhash.signed(a), simhash.signed(b)))) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 4}
    assert links == want
    roots = {x["fp"]: x["root"] for x in simhash.slice_roots(table.select("fp")).collect()}
    assert set(roots) == {simhash.signed(f) for f in fps} and len(set(roots.values())) < len(fps) - 50
    assert all(((f ^ r) % (1 << 64)).bit_count() <= 4 for f, r in roots.items())


def test_chain_keys_find_every_near_pair():
    r = random.Random(6)
    keys = simhash.chain_keys()
    assert len(keys) == 25
    masks = simhash.segment_masks()
    for _ in range(5000):
        x = sum(1 << b for b in r.sample(range(64), r.randint(0, 4)))

        def chain(start):
            total, ok = 0, True
            for n in range(5):
                total += (x & masks[(start + n) % 5]).bit_count()
                ok &= total <= (n + 1) * 4 // 5
            return ok
        assert any(not x & m and chain(s) for s, m in keys)


def test_components(spark):
    r = random.Random(7)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)] + [(500, x) for x in range(501, 600)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({n for a, b in edges if a != b for n in (a, b)})
    near = {frozenset(e) for e in edges}
    want = smallest_reachable(nodes, lambda i, j: frozenset((nodes[i], nodes[j])) in near)
    assert got == {n: root for n, root in want.items() if n != root}


def test_exact_copies_with_a_heavy_text(spark):
    r = random.Random(9)
    docs = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"text {r.randrange(300)}") for i in range(3000)] + [(0, "hot"), (2997, "hot"), (None, "hot")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = exact_dedup.mark_copies(df, slots=64).collect()
    groups = {}
    for d, t in docs:
        groups.setdefault(t or "", []).append(d)
    best = {t: max(x for x in ds if x is not None) for t, ds in groups.items()}
    want = sorted((d, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in docs if d is not None)
    assert sorted((x["doc_id"], x["keep_id"], x["group_size"], x["text_sha256"]) for x in got if x["doc_id"] is not None) == want
    kept = [x for x in got if x["kept"]]
    assert sorted(x["doc_id"] for x in kept) == sorted(best.values())
    left = exact_dedup.drop_copies(df, slots=64).collect()
    assert sorted((x["doc_id"], x["text"] or "") for x in left) == sorted((d, t) for t, d in best.items())
    digests = df.select("doc_id", exact_dedup.text_digest(F.col("text")).alias("digest"), F.lit(0).alias("row"))
    heavy = [x["digest"] for x in exact_dedup.verified_winners(digests, slots=8).collect()]
    assert heavy == [hashlib.sha256(b"hot").hexdigest()]


def removed(texts, length):
    counts = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    for t in texts:
        cover = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if counts[t[p:p + length]] > 1:
                cover[p:p + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~cover])
        spans = int(cover[:1].sum() + (cover[1:] & ~cover[:-1]).sum())
        yield len(t), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("seed,length", [(5, 400), (6, 40)])
def test_repeated_spans(spark, seed, length):
    r = random.Random(seed)
    base, passage = [prose(seed * 10 + i, 250) for i in range(3)], prose(seed, 70)
    texts = []
    for i in range(36):
        kind = i % 6
        if kind == 0:
            t = prose(100 + i, 150)
        elif kind == 1:  # edits at random places
            words = base[i % 3].split()
            for _ in range(r.randint(1, 5)):
                words[r.randrange(len(words))] = r.choice(WORDS)
            t = " ".join(words)
        elif kind == 2:  # a passage between other texts
            t = prose(i, r.randint(0, 30)) + passage + prose(i + 1, r.randint(0, 30))
        elif kind == 3:
            t = base[1] if i % 2 else "x" * r.randint(380, 900)
        elif kind == 4:  # periodic
            t = (r.choice(WORDS) + " ") * r.randint(50, 250) + prose(i, 20)
        else:  # overlapping parts of one text, at the length and just off it
            a = r.randint(0, 200)
            t = prose(i, 5) + base[2][a:a + r.randint(390, 460)] + prose(i + 2, 3) + base[2][a + 50:a + 50 + length + r.randint(-1, 1)]
        texts.append((i, t))
    texts += [(100, None), (101, ""), (102, "é" * 450), (103, "é" * 300)]
    got = suffix_dedup.repeated_spans(spark.createDataFrame(texts, "doc_id long, text string"), length=length).collect()
    want = dict(zip([d for d, _ in texts], removed([(t or "").encode() for _, t in texts], length)))
    assert {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got} == want
    for x in got:
        spans = [tuple(map(int, s.split(":"))) for s in x["spans"]]
        assert len(spans) == x["n_spans"] and sum(e - s for s, e in spans) == x["n_removed"]


def test_passages_that_start_at_an_anchor(spark):
    texts = []
    for k in range(24):  # one text starts with the passage and so at its first anchor, the other has other bytes before it
        long = prose(300 + k, 220).encode()
        where = suffix_dedup.minima(suffix_dedup.Hashes(long).grams(suffix_dedup.GRAM), suffix_dedup.SPAN)
        at = int(np.flatnonzero(where == np.arange(len(where)))[0])
        passage = long[at:at + 900]
        pair = [passage + b"!" + prose(600 + k, 10).encode(), prose(500 + k, 10).encode() + passage]
        texts += pair[::-1] if k % 2 else pair
    rows = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    want = dict(enumerate(removed(texts, 400)))
    assert {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in suffix_dedup.repeated_spans(rows).collect()} == want


def test_texts_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    texts = [b"".join(w.encode() for w in (prose(s, 900), " ", prose(99, 200))) for s in (1, 2)]
    hashes, first, last = suffix_dedup.marks(texts[0], 400)
    assert sum(e - s + 1 for s, e in zip(first, last)) == len(texts[0]) - 399
    assert first == sorted(first)
