"""Steps that must not grow faster than their input: results and layout on small rows."""

import glob
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import bpe, decode, nbest, unigram, wrap
from tessera.plans import hyps, streams
from tessera.session import stored
from tessera.streaming import jobs


def test_words_segmented_at_once_are_those_segmented_alone():
    rng = random.Random(4)
    for _ in range(60):
        letters = rng.choice(["ab", "abc", "ab\u00e9", "a<w/>"])
        words = list({"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(40)})
        symbols = [*letters, *(c + bpe.END_OF_WORD for c in letters)]
        ranks = {}
        for k in range(rng.randint(0, 14)):
            pair = (rng.choice([s for s in symbols if not s.endswith(bpe.END_OF_WORD)]), rng.choice(symbols))
            ranks.setdefault(pair, k)
            symbols.append("".join(pair))
        assert bpe.segment_words(words, ranks) == [bpe.segment_word(w, ranks) for w in words]
    # a spelling made in two ways: the last merge makes what the third takes
    ranks = {("b", "c"): 0, ("a", "bc"): 1, ("abc", "d"): 2, ("a", "b"): 3, ("ab", "c"): 4}
    words = ["abcd", "xabcdx", "ab", "cab\U000F0001", "a"]
    assert bpe.segment_words(words, ranks) == [bpe.segment_word(w, ranks) for w in words]
    assert bpe.segment_words([], ranks) == []


def test_many_documents_share_folders(spark, tmp_path):
    rows = [(d, k, f" a{d}  b{k} ") for d in range(200) for k in range(2)]
    spark.createDataFrame(rows, streams.LINE_SCHEMA).write.json(f"{tmp_path}/in")
    out = jobs.mux_demux(spark, f"{tmp_path}/in", streams.LINE_SCHEMA, T.collapse_ws, f"{tmp_path}/out", f"{tmp_path}/ckpt", folders=4)
    assert sorted(map(tuple, out.select("doc_id", "line_no", "text").collect())) == sorted((d, k, f"a{d} b{k}") for d, k, _ in rows)
    folders = glob.glob(f"{tmp_path}/out/*=*")
    assert 1 < len(folders) <= 4
    ids = [{r.doc_id for r in spark.read.parquet(f).select("doc_id").collect()} for f in folders]
    assert sum(map(len, ids)) == 200                   # no document is in two folders


def test_lines_are_numbered_without_their_texts(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(7, "a\nb", "s"), (3, "c", "s"), (9, "d\n\ne", "t")], "doc_id long, text string, source string").write.parquet(
        f"{tmp_path}/documents.parquet")
    kept = []
    monkeypatch.setattr(streams, "materialize", lambda df, f=streams.materialize: kept.append(df.columns) or f(df))
    got = {(r.source, r.doc_id, r.line_no): r.sent_id for r in streams.stream_sentence_ids(spark, str(tmp_path)).collect()}
    assert got == {("s", 3, 0): 0, ("s", 7, 0): 1, ("s", 7, 1): 2, ("t", 9, 0): 0, ("t", 9, 1): 1, ("t", 9, 2): 2}
    assert kept == [["doc_id", "line_no"], ["doc_id", "line_no", "source", "place"]]


def test_lattices_of_many_words():
    pieces = {p: s for p, s in zip(["a", "b", "ab", "ba", "aba", "\u2581", "\u2581a"], np.log([.2, .1, .2, .1, .1, .2, .1]))}
    words, n = ["\u2581a", "\u2581abab", "\u2581ax", "\u2581bbaba", "x"], np.array([3.0, 1.0, 2.0, 5.0, 1.0])
    found = [unigram.edge_lists(w, {p: k for k, p in enumerate(pieces)}, 3) for w in words]
    flat = [np.array([x for f in found for x in f[k]]) for k in range(3)]
    lat = unigram.Lattices(np.array([len(w) for w in words]), np.array([len(f[0]) for f in found]), *flat, np.array([*pieces.values(), -20.0]))
    likely, backward = lat.forward()[lat.last], lat.backward()[lat.first]
    want = [unigram.expected(w, pieces, 3, -20.0)[0] for w in words]
    assert likely == pytest.approx(want) and backward == pytest.approx(want)
    names, paths = [*pieces, "x"], [[] for _ in words]
    for of, edges in lat.paths():
        for w, e in zip(of, edges):
            paths[w].insert(0, names[lat.piece[e]])
    assert paths == [unigram.best(w, pieces, 3, -20.0)[1] for w in words]


def test_stored_lattices_serve_fewer_pieces(spark):
    table = spark.createDataFrame([("\u2581abab", 3), ("\u2581ba", 2), ("\u2581aab", 1)], "word string, n long")
    every = {p: -float(k + 1) for k, p in enumerate(["a", "b", "\u2581", "ab", "ba", "\u2581a", "aba"])}
    known = unigram.lattices(table, every)
    some = {p: s for p, s in every.items() if p not in ("ab", "\u2581a")}
    logp, counts = unigram.counts_of(table, some, known, list(every))
    logp_, counts_ = unigram.counts_of(table, some)
    assert logp == pytest.approx(logp_) and set(counts) == set(some)
    assert {p: v for p, v in counts.items()} == {p: pytest.approx(v) for p, v in counts_.items()}




def test_word_lists_go_through_the_shuffle_as_text(spark):
    pieces = spark.createDataFrame([(1, 0, False, 2, 0, "A b"), (1, 0, False, 2, 1, "C"), (1, 1, True, 1, 0, ""), (2, 0, False, 1, 0, "x" * 60000 + " y")],
                                   "doc_id long, line_no long, is_empty boolean, n_pieces int, piece_no int, text string")
    hyp = decode.echo_decode(pieces, 2, words=True)
    out = wrap.unwrap_pieces(hyp, words="nbest_words")
    got = {(r.doc_id, r.line_no, r["rank"]): r.nbest_words for r in out.collect()}
    end = {"</s>": "-0.1"}
    assert got[1, 0, 0] == [{"A": "-0.5", "a": "-1.5"}, {"b": "-1.5"}, end, {"C": "-0.5", "c": "-1.5"}, end]
    assert got[1, 1, 0] == got[1, 1, 1] == []
    assert got[2, 0, 1] == [{"x" * 60000: "-1.5"}, {"y": "-1.5"}, end]      # no JSON key may be as long
    part = hyp.select(F.struct(*wrap.packed_words("nbest_words")).alias("p"))
    assert part.where("doc_id = 1 and (p.m is not null or p.w is null)").count() == 0
    both = part.select(wrap.unpacked_words(F.col("p")).alias("u"))
    assert sorted(map(str, both.collect())) == sorted(map(str, hyp.select(F.col("nbest_words").alias("u")).collect()))


def test_decoder_output_is_stored_in_columns_and_meets_its_pieces_where_it_is(spark):
    units = spark.createDataFrame([(f, k, f"W{k} x y") for f in range(3) for k in range(40)], "doc long, item long, text string")
    raw = stored(hyps.words_raw(units, "doc", "item"), "test-words")
    assert raw.inputFiles() and raw.count() == 3 * 40 * 2 * 6
    parsed = nbest.parse_nbest_words(raw, n_best=2)
    both = parsed.join(units.withColumnRenamed("doc", "src_file"), ["src_file", "item"])
    assert both.where("upper(translation) <> upper(text)").count() == 0 and both.count() == 240
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning(src_file" in line and "item" in line]
    assert len(moved) == 1 and "REPARTITION_BY_COL" in moved[0]                      # text, before it becomes maps
    assert len(re.findall(r"hashpartitioning\(src_file#\d+L, block", plan)) == 0


def test_fields_of_a_token_line_come_in_pairs(spark):
    rests = ["a 1\u2003b\t2", " \u00a0x  -1 ", "a 1 b", "", "a\x1cb 3 c\x0b4", "a 1 a 2"]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rests)], "k int, r string")
    got = [r.m for r in nbest.with_alternatives(df, F.col("r"), "m").orderBy("k").collect()]
    assert got == [{"a": "1", "b": "2"}, {"x": "-1"}, {"a": "1"}, {}, {"a\x1cb": "3", "c": "4"}, {"a": "2"}]
