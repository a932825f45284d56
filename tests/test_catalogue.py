"""Scorer registry and the catalogue of test sets, against plain Python."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.functions import processors as P
from tessera.operators import catalogue as C
from tessera.operators import scorers, scoring

FILES = {"a.src": "The Cat sat\n\nlong dog", "a.ref": "THE CAT SAT\n\nLONG DOG\n", "a.ref2": "x\ny\nLONG DOG RUNS", "a.query": "CAT\n\nDOG ||| none\n",
         "b+1.src": "uno dos\ntres\n", "b+1.ref": "<2EN> UNO DOS\n<2EN> TRES", "b.extra": "one two\nthree", "c.src": "x\n", "c.ref": "x\ny\n", "empty": ""}


@pytest.fixture(scope="module")
def folder():
    d = tempfile.mkdtemp(prefix="tessera cat ")
    for name, text in FILES.items():
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    return d


def decoder():
    def factory():
        return lambda texts, *extras: [[t.upper() + "".join(" | " + e[i].upper() for e in extras), "second"] for i, t in enumerate(texts)]
    return factory


def exact():
    """A scorer of the test: the share of segments equal to their first reference, times an argument."""
    def rows(s):
        times = F.coalesce(F.try_element_at("args", F.lit("times")), F.lit("1")).cast("double")
        return s.select("test_set", (F.col("hyp") == F.get("refs", 0)).cast("double").alias("same"), times.alias("times"))
    return scorers.Scorer("Exact", rows, lambda: [F.avg("same").alias("same"), F.max("times").alias("times"), F.count("same").alias("n")],
                          lambda: {"share": F.col("same") * F.col("times"), "n": F.coalesce("n", F.lit(0))})


@pytest.fixture
def with_exact():
    scorers.register(exact())
    yield
    del scorers.SCORERS["Exact"]


def results(df):
    return {(r.test_set, r.scorer, r.metric): r.value if r.error is None else r.error for r in df.collect()}


def test_all_sets_in_one_job(spark, folder, with_exact):
    tagged = P.TextProcessor("tag", pre_piece=lambda p: F.concat(F.lit("<2en> "), p))
    p = lambda *names: [f"{folder}/{n}" for n in names]
    sets = {"a": C.Entry(p("a.src"), p("a.ref", "a.ref2"), {"SacrebleuScorer": {}, "QueryScorer": {"query_fp": p("a.query")[0]}, "Exact": {"times": "2"}}),
            "b": C.Entry(p("b+1.src"), p("b+1.ref"), {"Exact": {}, "TerScorer": {}}, tagged),
            "b raw": C.Entry(p("b+1.src"), p("b+1.ref"), {"Exact": {}}, tagged, preprocess=False),
            "b two": C.Entry(p("b+1.src", "b.extra"), p("b+1.ref"), {"Exact": {}, "QueryScorer": {}}),
            "c": C.Entry(p("c.src"), p("c.ref"), {"Exact": {}}), "none": C.Entry(p("empty"), p("empty"), {"Exact": {}}),
            "gone": C.Entry(p("a.src", "nowhere"), p("a.ref"), {"Exact": {}, "QueryScorer": {"query_fp": f"{folder}/no query"}})}
    out = tempfile.mkdtemp(prefix="tessera-scores-") + "/scores"
    rows = C.score_catalogue(spark, sets, decoder(), output=out).collect()
    got = {(r.test_set, r.scorer, r.metric): r.value if r.error is None else r.error for r in rows if r.test_set != "gone"}
    want = {("a", "SacrebleuScorer", "bleu"): got["a", "SacrebleuScorer", "bleu"],
            ("a", "QueryScorer", "inserted"): 2.0, ("a", "QueryScorer", "expected"): 3.0, ("a", "QueryScorer", "score"): 0.75,
            ("a", "Exact", "share"): 2.0, ("a", "Exact", "n"): 3.0, ("b", "Exact", "share"): 1.0, ("b", "Exact", "n"): 2.0,
            ("b", "TerScorer", None): scorers.NO_SCORER, ("b raw", "Exact", "share"): 0.0, ("b raw", "Exact", "n"): 2.0,
            ("b two", "Exact", "share"): 0.0, ("b two", "Exact", "n"): 2.0, ("b two", "QueryScorer", "inserted"): 0.0,
            ("b two", "QueryScorer", "expected"): 0.0, ("b two", "QueryScorer", "score"): None, ("c", None, None): C.UNEQUAL,
            ("none", "Exact", "share"): None, ("none", "Exact", "n"): 0.0}
    assert got == want
    assert sorted(r.error for r in rows if r.test_set == "gone") == [C.MISSING + f"{folder}/no query", C.MISSING + f"{folder}/nowhere"]
    pairs = spark.createDataFrame([(0, "THE CAT SAT", "THE CAT SAT", "x"), (1, "", "", "y"), (2, "LONG DOG", "LONG DOG", "LONG DOG RUNS")],
                                  "k int, hyp string, ref string, ref2 string")
    assert got["a", "SacrebleuScorer", "bleu"] == scoring.corpus_bleu(pairs, [], ["k"], refs=("ref", "ref2")).first().bleu
    assert os.path.exists(f"{out}/_SUCCESS")


def test_extra_sources_reach_the_decoder(spark, folder):
    sets = {"b": C.Entry([f"{folder}/b+1.src", f"{folder}/b.extra"], [f"{folder}/b+1.ref"])}
    hyps = C.translate_sets(C.read_sets(spark, sets), sets, decoder())
    assert {r.line_no: r.hyp for r in hyps.collect()} == {0: "UNO DOS | ONE TWO", 1: "TRES | THREE"}


def test_one_file_and_nothing_there(spark, folder):
    one = results(C.score_file(spark, f"{folder}/a.src", f"{folder}/a.ref", decoder()))
    assert list(one) == [(f"{folder}/a.src", "SacrebleuScorer", "bleu")]
    gone = results(C.score_file(spark, f"{folder}/x", f"{folder}/a.ref", decoder()))
    assert gone == {(f"{folder}/x", None, None): C.MISSING + f"{folder}/x"}
    with pytest.raises(ValueError):
        C.score_catalogue(spark, {"a": C.Entry([], ["x"])})


def test_scores_of_a_table(spark, with_exact):
    segs = spark.createDataFrame([("a", "X", ["x"], None), ("a", None, ["y"], " "), ("b", "q q", ["q"], "q")],
                                 "test_set string, hyp string, refs array<string>, query string")
    asked = spark.createDataFrame([("a", "Exact", None), ("a", "Exact", None), ("a", "SacrebleuScorer", {"lowercase": "true"}),
                                   ("b", "QueryScorer", {}), ("z", "QueryScorer", None), ("z", "SacrebleuScorer", {}), ("a", None, None)],
                                  "test_set string, scorer string, args map<string,string>")
    got = results(scorers.score(segs, asked))
    assert got["a", "Exact", "share"] == 0.0 and got["a", "Exact", "n"] == 2.0
    assert got["b", "QueryScorer", "inserted"] == 2.0 and got["b", "QueryScorer", "score"] == 0.0
    assert got["z", "QueryScorer", "expected"] == 0.0 and got["z", "SacrebleuScorer", "bleu"] == 0.0
    assert got["a", None, None] == scorers.NO_SCORER
    pairs = spark.createDataFrame([(0, "x", "x"), (1, "", "y")], "k int, hyp string, ref string")
    assert got["a", "SacrebleuScorer", "bleu"] == scoring.corpus_bleu(pairs, [], ["k"]).first().bleu
    with pytest.raises(ValueError):
        scorers.register(exact())
