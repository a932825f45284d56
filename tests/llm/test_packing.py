"""Bin completion against exhaustive packing; packed documents against whole encodings."""

import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import packing
from tessera.llm.common import table
from tessera.llm.queries import QUERIES
from tests.llm.helpers import edge_documents

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def fewest(lengths, capacity):
    """Exhaustive: every piece into every sequence or a new one."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= lengths[i]:
                left = list(rooms)
                left[left.index(room)] -= lengths[i]
                go(i + 1, left)
        go(i + 1, [*rooms, capacity - lengths[i]])
    go(0, [])
    return best


def test_bin_completion_finds_the_fewest_sequences():
    better = 0
    for seed in range(400):
        r = random.Random(seed)
        capacity = r.choice([10, 20, 30, 50, 100])
        lengths = [r.randint(1, r.choice([capacity // 2, capacity - 1])) for _ in range(r.randint(1, 10))]
        found = packing.bin_completion(lengths, capacity, None, None)
        assert sorted(x for b in found for x in b) == sorted(lengths) and all(sum(b) <= capacity for b in found)
        want = fewest(lengths, capacity)
        assert len(found) == want and packing.lower_bound(lengths, capacity) <= want
        better += len(packing.best_fit(lengths, capacity)) > want
    assert better  # the search does what best fit alone does not


def undominated(lengths, room):
    """Fillings by trying all, without those that another one dominates."""
    sets = {()}
    for x in lengths:
        sets |= {(*s, x) for s in sets if sum(s) + x <= room}
    keep = set()
    for s in sets:
        left = list(lengths)
        for x in s:
            left.remove(x)
        parts = {()}
        for x in s:
            parts |= {(*p, x) for p in parts}
        gaps = room - sum(s)
        if not any(y - gaps <= sum(p) <= y and (len(p) != 1 or y > p[0]) for y in left for p in parts):
            keep.add(tuple(sorted(s)))
    return keep


def test_fillings_are_the_undominated_ones():
    for seed in range(200):
        r = random.Random(seed)
        lengths = [r.randint(1, 14) for _ in range(r.randint(1, 8))]
        counts = {x: lengths.count(x) for x in lengths}
        room = r.randint(1, 25)
        found = packing.fillings(counts, sum(1 << x for x in counts), room, room, None)
        assert {tuple(sorted(f)) for _, f in found} == {s for s in undominated(lengths, room)}
        assert all(w == room - sum(f) for w, f in found) and [w for w, _ in found] == sorted(w for w, _ in found)


def test_limited_search_still_packs_all():
    r = np.random.default_rng(1)
    lengths = r.integers(1000, 2000, 300).tolist()
    found = packing.bin_completion(lengths, 4096, 50, 8)
    assert sorted(x for b in found for x in b) == sorted(lengths) and all(sum(b) <= 4096 for b in found)
    assert len(found) <= len(packing.best_fit(lengths, 4096))


def check(rows, docs, capacity):
    """Pieces are the documents' ids in order; sequences are full from 0 on without gaps."""
    encoder = Tokenizer.from_file(WORDS)
    want = sorted(((d, *encoder.encode(t or "", add_special_tokens=False).ids, 1) for d, t in docs), key=repr)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for doc in {w[0] for w in want}:
        texts = [w[1:] for w in want if w[0] == doc]
        pieces = sorted((p, a, tuple(t[a:a + capacity])) for t in texts for p, a in enumerate(range(0, len(t), capacity)))
        own = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc])
        assert own == sorted((p, a, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for p, a, x in pieces)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_seq), sum(r["length"] for r in rows)


def test_query_packs_whole_documents(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    n, tokens = check(QUERIES["op11_packing"](spark, SF).collect(), docs, packing.CAPACITY)
    assert n == -(-tokens // packing.CAPACITY)


def test_groups_meet_again_in_later_rounds(spark):
    r = random.Random(7)
    lengths = [r.randint(1, 99) for _ in range(2000)]
    pieces = spark.createDataFrame([(i * 8 - 50, x) for i, x in enumerate(lengths)], "row long, length long")
    rows = {r["row"]: r for r in packing.place(pieces, 100, group=100).collect()}
    assert sorted(rows) == [i * 8 - 50 for i in range(2000)]
    by_seq = defaultdict(list)
    for i, x in enumerate(lengths):
        by_seq[rows[i * 8 - 50]["sequence_id"]].append((rows[i * 8 - 50]["offset"], x))
    for own in by_seq.values():
        at = 0
        for offset, x in sorted(own):
            assert offset == at
            at += x
        assert at <= 100
    assert len(by_seq) <= 1.03 * packing.lower_bound(lengths, 100)  # in groups of 100 pieces, of 1 to 99 tokens


def test_edge_documents(spark):
    docs = edge_documents(spark)
    own = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(packing.packed_pieces(docs, WORDS).collect(), own, packing.CAPACITY)
    check(packing.packed_pieces(docs, WORDS, capacity=7, group=200).collect(), own, 7)
    assert packing.packed_pieces(docs.limit(0), WORDS).collect() == []


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "Ab c<|endoftext|>d"), (2, "x　y  \n z"), (3, None)], "doc_id long, text string")
    encoder = Tokenizer.from_file(WORDS)
    want = {d: [*encoder.encode(t or "", add_special_tokens=False).ids, 1] for d, t in docs.collect()}
    (row,) = packing.sequences(docs, WORDS).collect()
    assert sorted(s["doc_id"] for s in row["spans"]) == [1, 2, 3] and row["length"] == len(row["ids"])
    for s in row["spans"]:
        assert row["ids"][s["offset"]:s["offset"] + s["length"]] == want[s["doc_id"]]


def test_words_are_looked_up_once_and_parted_from_any_tail(monkeypatch):
    encoder, seen = packing.WordIds(WORDS, kept=4), []
    joined = encoder.joined
    monkeypatch.setattr(encoder, "joined", lambda words, *rest: seen.extend(words) or joined(words, *rest))
    texts = ["Baum*** Baum$$$ baum\nbaum, baum&%", "", "é#  x_*  'tis*", "<|endoftext|>* baum***"]
    for _ in range(3):  # some words are forgotten in between
        assert encoder.encode(texts) == [np.array(encoder.ids(t), "<u4").tobytes() for t in texts]
    first = seen[:len(set(seen))]
    assert first.count("baum") == 1 and not [w for w in seen if w.lower().startswith("baum") and w != "baum"]
