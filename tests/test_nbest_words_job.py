"""Word alternatives and unexpanded rows in the folder job."""

import glob
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators import wrap
from tessera.operators.translate import format_rows, translate_folder, translate_lines

TEXTS = {"a.txt": ["one Two", "", " ".join(f"W{i}" for i in range(450)), "see x.y@z.org now"], "sub/b.txt": ["last"]}


def decoders():
    """Two decoder factories (local functions, so that tasks need not import this module)."""
    def factory():
        def alternatives(text, upper):
            words = [w.upper() if upper else w for w in text.split()]
            return " ".join(words), [[(w, -1), ("zz", -2), (w, -3)] for w in words] + [{"</s>": 0}]
        return lambda texts: [[alternatives(t, False), alternatives(t, True), ("third", [])] for t in texts]

    def plain():
        return lambda texts: [[t, t.upper()] for t in texts]
    return factory, plain


def brute(lines, n_best):
    """``(line, rank) → translation, word lists`` by plain Python."""
    out = {}
    for i, line in enumerate(lines):
        for r in range(n_best):
            words = [w.upper() if r else w for w in line.split()]
            pieces = [words[k:k + 200] for k in range(0, len(words), 200)]
            lists = [d for p in pieces for d in [{w: "-3", "zz": "-2"} for w in p] + [{"</s>": "0"}]]
            out[i, r] = (" ".join(words), lists)
    return out


@pytest.fixture(scope="module")
def folder():
    d = tempfile.mkdtemp(prefix="tessera-words-")
    for name, lines in TEXTS.items():
        os.makedirs(os.path.dirname(f"{d}/{name}"), exist_ok=True)
        with open(f"{d}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    return d


def rows_of(out, name):
    return [json.loads(line) for f in sorted(glob.glob(f"{out}/doc={name.replace('/', '%2F')}/part-*")) for line in open(f)]


def test_word_lists_of_every_line(spark, folder):
    target = tempfile.mkdtemp(prefix="tessera-words-out-")
    out = translate_folder(spark, folder, target, decoder_factory=decoders()[0], n_best=2, words=True)
    for name, lines in TEXTS.items():
        want = brute(lines, 2)
        got = rows_of(out, name)
        assert [r["id"] for r in got] == [i for i in range(len(lines)) for _ in range(2)]
        for k, r in enumerate(got):
            assert list(r) == ["id", "nbest_words", "translation"]
            assert (r["translation"], r["nbest_words"]) == want[r["id"], k % 2]
            assert all(list(d) == sorted(d) for d in r["nbest_words"])
    plain = translate_folder(spark, folder, target, decoder_factory=decoders()[1], n_best=2)
    assert all("nbest_words" not in r for r in rows_of(plain, "a.txt"))


def test_unexpanded_rows(spark, folder):
    target = tempfile.mkdtemp(prefix="tessera-words-out-")
    out = translate_folder(spark, folder, target, decoder_factory=decoders()[0], n_best=2, words=True, expand=False)
    assert len(os.listdir(f"{target}/_stages")) == 1
    for name, lines in TEXTS.items():
        want = brute(lines, 2)
        got = rows_of(out, name)
        assert [r["id"] for r in got] == list(range(len(lines)))
        for r in got:
            assert r["translation"] == [want[r["id"], k][0] for k in range(2)]
            assert r["nbest_words"] == [want[r["id"], k][1] for k in range(2)]
    with pytest.raises(ValueError):
        translate_folder(spark, folder, target, decoder_factory=decoders()[0], n_best=2, words=True, expand=False, fmt="marian")


def test_unexpanded_equals_expanded_with_tags(spark):
    lines = spark.createDataFrame([("d", i, t) for i, t in enumerate(TEXTS["a.txt"])], "doc string, line_no long, text string")
    rows = translate_lines(lines, decoder_factory=decoders()[1], n_best=2, extract_tags=True).collect()
    arrays = translate_lines(lines, decoder_factory=decoders()[1], n_best=2, extract_tags=True, expand=False).collect()
    assert {(r.line_no, k): t for r in arrays for k, t in enumerate(r.translation)} == {(r.line_no, r.rank): r.translation for r in rows}
    assert any("x.y@z.org" in t for r in arrays for t in r.translation)


def test_incomplete_ranks_and_blanks(spark):
    """A rank that a piece lacks goes; a blank line has all ranks; no common rank leaves empty arrays."""
    m = "map('a', '1')"
    rows = [(0, 0, 2, False, 0, "a"), (0, 0, 2, False, 1, "A"), (0, 1, 2, False, 0, "b"),
            (1, 0, 1, True, 0, "ghost"), (2, 0, 2, False, 0, "x"), (2, 1, 2, False, 1, "y")]
    hyps = spark.createDataFrame(rows, "line_no long, piece_no int, n_pieces int, is_empty boolean, rank int, translation string")
    hyps = hyps.withColumn("w", F.array(F.expr(m)))
    out = {r.line_no: r for r in wrap.collate_pieces(hyps, ["line_no"], words="w", n_best=3).collect()}
    assert out[0].translation == ["a b"] and out[0].nbest_words == [[{"a": "1"}, {"a": "1"}]]
    assert out[1].translation == ["", "", ""] and out[1].nbest_words == [[], [], []]
    assert out[2].translation == [] and out[2].nbest_words == []
    none = wrap.collate_pieces(hyps.limit(0), ["line_no"], words="w", n_best=3)
    assert none.count() == 0
    assert format_rows(none, "json").columns[-1] == "value"
