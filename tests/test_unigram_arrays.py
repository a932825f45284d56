"""Lattices and best segmentations of many words at once against those of one word."""

import random

import numpy as np
import pytest

from tessera.operators import unigram

WORDS = ["▁abab", "▁", "▁ax", "▁bbaba", "x", "▁\U0001f600b\U0001f600\U0001f601a", "▁xx\x1cyb", "▁" + "ab" * 50]


def words(seed, count=300):
    rng = random.Random(seed)
    return WORDS + ["▁" + "".join(rng.choice("abcdeé\U0001f600") for _ in range(rng.randint(0, 12))) for _ in range(count)]


@pytest.mark.parametrize("pieces", [[], ["▁"], ["a", "b", "▁", "ab", "ba", "aba", "▁a"], ["abab", "b", "▁ab", "cde", "\U0001f600b", "é"]])
def test_edges_and_best_of_many_words(pieces):
    scores = {p: -1.0 - k % 3 for k, p in enumerate(pieces)}        # with ties
    unknown = min(scores.values(), default=0.0) - unigram.UNKNOWN
    trie, longest, ids = unigram.Trie(pieces), max(map(len, pieces), default=1), {p: k for k, p in enumerate(pieces)}
    every = words(len(pieces))
    lengths, edges_of, *flat = trie.edges(every)
    want = [unigram.edge_lists(w, ids, longest) for w in every]
    assert lengths.tolist() == [len(w) for w in every] and edges_of.tolist() == [len(x[0]) for x in want]
    assert [f.tolist() for f in flat] == [[v for x in want for v in x[k]] for k in range(3)]
    got = unigram.best_of_all(every, trie, np.array([*scores.values(), unknown]))
    assert got == [" ".join(unigram.best(w, scores, longest, unknown)[1]) for w in every]


def test_lattices_are_stored_by_thousands_of_words(spark):
    table = spark.createDataFrame([(w, k + 1) for k, w in enumerate(dict.fromkeys(words(9)))], "word string, n long").coalesce(1)
    pieces = {p: -1.0 - k for k, p in enumerate(["a", "b", "▁", "ab", "▁a", "cd"])}
    known = unigram.lattices(table, pieces)
    assert known.count() == 1
    logp, counts = unigram.counts_of(table, pieces, known, list(pieces))
    unknown = min(pieces.values()) - unigram.UNKNOWN
    rows = [(r.n, unigram.expected(r.word, pieces, 2, unknown)) for r in table.collect()]
    assert logp == pytest.approx(sum(n * x for n, (x, _) in rows))
    assert {p: e for p, (e, _) in counts.items()} == pytest.approx({p: sum(n * x.get(p, 0.0) for n, (_, x) in rows) for p in pieces})
