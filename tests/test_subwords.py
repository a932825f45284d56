"""Merges and vocabulary filter against one-at-a-time learning; the unigram model against all segmentations."""

import math
import random
from collections import Counter

import pytest

from tessera.functions import processors as P
from tessera.functions import text as T
from tessera.operators import bpe, unigram
from tests.test_bpe_truecase import LINES, _lines, brute_learn


def corpus(seed, n=60):
    r = random.Random(seed)
    words = ["".join(r.choice("abcd") for _ in range(r.randint(1, 7))) for _ in range(25)]
    return [" ".join(r.choice(words) for _ in range(r.randint(0, 9))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "doc_id long, line_no long, text string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_several_merges_a_step_equal_one_at_a_time(spark, seed):
    texts = corpus(seed)
    got = [(r.left, r.right, r.cnt) for r in bpe.learn_merges(frame(spark, texts), 25, checkpoint_every=2).orderBy("rank").collect()]
    assert got == brute_learn(texts, 25)


def test_learning_ends_when_no_pair_is_left(spark):
    got = [(r.left, r.right, r.cnt) for r in bpe.learn_merges(frame(spark, ["ab ab", "aaa", "", "c"]), 50).orderBy("rank").collect()]
    assert got == brute_learn(["ab ab", "aaa", "", "c"], 50)
    assert bpe.learn_merges(frame(spark, ["", "  "]), 5).collect() == []


def test_independent_steps():
    assert bpe.independent([("a", "b", 9), ("c", "d", 8), ("b", "c", 7)], True) == [("a", "b", 9), ("c", "d", 8)]
    assert bpe.independent([("a", "b", 9), ("c", "d", 7), ("b", "c", 7)], True) == [("a", "b", 9)]  # a tie may be won by a new pair
    assert bpe.independent([("a", "b", 9), ("c", "d", 7)], False) == [("a", "b", 9)]  # the next pair is not known
    assert bpe.independent([("a", "b", 9), ("c", "d", 7)], True) == [("a", "b", 9), ("c", "d", 7)]
    assert bpe.independent([("a", "a", 9), ("a", "b", 9)], True) == [("a", "a", 9)]


def apart(word, merges, known):
    """Units by the merges in order, then each that is not known replaced by its two parts until none is left."""
    ranks = {(l, r): k for k, (l, r, _) in reversed(list(enumerate(merges)))}
    units = bpe.segment_word(word, ranks)
    made = {}
    for l, r, _ in merges:
        made.setdefault(l + r, (l, r))
    while True:
        for i, u in enumerate(units):
            final = i == len(units) - 1
            pair = made.get(u + "</w>" if final else u)
            if pair and (u if final else u + "@@") not in known:
                units[i:i + 1] = [pair[0], pair[1].removesuffix("</w>")] if final else list(pair)
                break
        else:
            return units


@pytest.mark.parametrize("threshold", [1, 3, 10, 10_000])
def test_vocabulary_filter(spark, threshold):
    texts = corpus(7)
    lines = frame(spark, texts)
    merges = bpe.learn_merges(lines, 20).cache()
    table = [(r.left, r.right, r.cnt) for r in merges.orderBy("rank").collect()]
    vocab = bpe.unit_counts(bpe.encode_corpus(lines, merges)).cache()
    known = {r.token for r in vocab.collect() if r.n >= threshold}
    got = {r.line_no: r.text for r in bpe.encode_corpus(lines, merges, vocab=vocab, threshold=threshold).collect()}
    for i, t in enumerate(texts):
        assert got[i] == " ".join("@@ ".join(apart(w, table, known)) for w in t.split())
        assert got[i].replace("@@ ", "") == t
    if threshold > 1000:
        assert all(len(u.removesuffix("@@")) == 1 for u in " ".join(got.values()).split())


def segmentations(word, pieces, unknown):
    """All segmentations of a word with their scores."""
    if not word:
        return [(0.0, [])]
    out = []
    for k in range(1, len(word) + 1):
        p = word[:k]
        s = pieces.get(p, unknown if k == 1 else None)
        if s is not None:
            out += [(s + rest, [p, *parts]) for rest, parts in segmentations(word[k:], pieces, unknown)]
    return out


def model(seed):
    r = random.Random(seed)
    pieces = {c: r.uniform(-6, -3) for c in "▁abc"}
    for _ in range(12):
        pieces["".join(r.choice("▁abc") for _ in range(r.randint(2, 4)))] = r.uniform(-6, -2)
    return pieces


@pytest.mark.parametrize("seed", range(6))
def test_lattices_against_all_segmentations(seed):
    pieces = model(seed)
    r = random.Random(seed + 100)
    for _ in range(40):
        word = "▁" + "".join(r.choice("abcx") for _ in range(r.randint(0, 7)))
        every = segmentations(word, pieces, -20.0)
        total = math.log(sum(math.exp(s) for s, _ in every))
        want = Counter()
        for s, parts in every:
            for p in parts:
                want[p] += math.exp(s - total)
        logp, found = unigram.expected(word, pieces, 4, -20.0)
        assert logp == pytest.approx(total)
        assert {p: c for p, c in found.items() if c > 1e-12} == pytest.approx({p: c for p, c in want.items() if c > 1e-12})
        score, parts = unigram.best(word, pieces, 4, -20.0)
        assert score == pytest.approx(max(s for s, _ in every)) and "".join(parts) == word
        without = "ab"
        if "ab" in pieces and word != "ab":
            score, parts = unigram.best(word, pieces, 4, -20.0, without)
            assert score == pytest.approx(max(s for s, p in every if without not in p))


def test_one_round_equals_brute_force(spark):
    texts = corpus(3, 30)
    words = Counter("▁" + w for t in texts for w in t.split())
    table = unigram.word_counts(frame(spark, texts))
    assert {r.word: r.n for r in table.collect()} == words
    parts = Counter()
    for w, n in words.items():
        for i in range(len(w)):
            for j in range(i + 1, min(len(w), i + 4) + 1):
                parts[w[i:j]] += n
    longer = sorted((p for p, n in parts.items() if len(p) > 1 and n > 1), key=lambda p: (-parts[p] * len(p), p))[:30]
    keep = {p: parts[p] * len(p) for p in parts if len(p) == 1 or p in longer}
    pieces = unigram.seed(table, 30, 4)
    assert pieces == pytest.approx({p: math.log(s / sum(keep.values())) for p, s in keep.items()})

    logp, counts = unigram.counts_of(table, pieces)
    low = min(pieces.values()) - unigram.UNKNOWN
    want, total = Counter(), 0.0
    for w, n in words.items():
        every = segmentations(w, pieces, low)
        z = sum(math.exp(s) for s, _ in every)
        total += n * math.log(z)
        for s, own in every:
            for p in own:
                want[p] += n * math.exp(s) / z
    assert logp == pytest.approx(total)
    assert {p: e for p, (e, _) in counts.items()} == pytest.approx({p: want[p] for p in pieces})
    assert sum(b * len(p) for p, (_, b) in counts.items()) == sum(n * len(w) for w, n in words.items())


def test_learned_model(spark):
    texts = corpus(5, 200)
    lines, report = frame(spark, texts), []
    pieces = {r.piece: r.score for r in unigram.learn(lines, 24, seed_size=120, max_length=6, report=report).collect()}
    assert len(pieces) <= 24 and set("abcd▁") <= set(pieces)
    assert sum(math.exp(s) for s in pieces.values()) == pytest.approx(1.0)
    for (n, before), (m, after) in zip(report, report[1:]):
        if n == m:  # no piece was taken away between the two: likelihood grows
            assert after >= before - 1e-6
    enc = unigram.encode(lines, spark.createDataFrame(list(pieces.items()), "piece string, score double"))
    low = min(pieces.values()) - unigram.UNKNOWN
    for r in enc.collect():
        for w, e in zip(texts[r.line_no].split(), r.text.replace(" ▁", "\n▁").split("\n")):
            own = e.split(" ")
            assert "".join(own) == "▁" + w
            assert sum(pieces.get(p, low) for p in own) == pytest.approx(max(s for s, _ in segmentations("▁" + w, pieces, low)))
    assert unigram.learn(frame(spark, ["", " "]), 10).collect() == []


def test_chain_uses_the_unigram_model(spark):
    lines = frame(spark, [*LINES, "zzz low"])
    pieces = unigram.learn(_lines(spark), 20)
    proc = P.get_processor("SpmMultilingualTextProcessor", "en", "sw")
    out = P.encode_lines(lines, proc, P.Models(pieces=pieces))
    back = {r.line_no: r.t for r in out.select("line_no", T.spm_decode("text").alias("t")).collect()}
    assert back == {i: t for i, t in enumerate([*LINES, "zzz low"])}
    plain = {r.line_no: r.text for r in unigram.encode(lines, pieces).collect()}
    assert {r.line_no: r.text for r in out.collect()} == plain and "zzz" in plain[5].split(" ")
