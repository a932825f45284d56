"""The request stream with several systems, against plain Python."""

import pytest

from tessera.functions import processors as P
from tessera.functions import text as T
from tessera.streaming import requests as R
from tessera.streaming.jobs import REQUEST_SCHEMA

SYSTEMS = {"aa-en": R.System(P.TextProcessor("q", pre=T.append_query), n_best=2, extract_tags=True, takes_query=True),
           "bb-en": R.System(P.get_processor("TextProcessor", "bb", "en"), n_best=3, words=True)}
LONG = " ".join(f"w{i}" for i in range(25))


def decoder():
    def factory():
        def decode(system, texts, n_best):
            if system == "aa-en":
                # loses the placeholders of the second rank; the last text of all has one rank only
                return [[t, "lost"] if "short" not in t else [t] for t in texts]
            return [[(t + f" {k}", [{"a": k, "b": 1}, [("c", 2), ("c", 3)]]) for k in range(5)] for t in texts]
        return decode
    return factory


ROWS = [(1, 0, "aa", "en", "mail x.y@z.org now\n\n" + LONG, "now\n\nw1"),
        (2, 0, "aa", "en", "one\ntwo", "only"),                       # number of queries differs
        (3, 0, "bb", "en", "plain x.y@z.org\n" + LONG, "q"),           # no queries here: a warning
        (4, 0, "cc", "en", "text", None),                            # no such system
        (5, 0, "bb", "en", None, None), (6, 0, None, "en", "text", None),
        (7, 0, "aa", "en", "short " + LONG, None),                   # one piece has one rank, the others two
        (8, 0, "bb", "en", " \n ", None), (1, 0, "bb", "en", "x", None)]


@pytest.fixture(scope="module")
def answers(spark):
    out = R.serve(spark.createDataFrame(ROWS, REQUEST_SCHEMA), SYSTEMS, decoder(), 10)
    return sorted((r.asDict(recursive=True) for r in out.collect()), key=lambda r: (r["conv_id"], r["id"], r["rank"], str(r["warning"])))


def rows(answers, conv):
    return [r for r in answers if r["conv_id"] == conv]


def test_queries_tags_and_ranks(answers):
    got = [r for r in rows(answers, 1) if r["nbest_words"] is None]
    assert [(r["id"], r["rank"], r["translation"]) for r in got] == [
        (0, 0, "mail  x.y@z.org  now ||| now"), (0, 1, "lost x.y@z.org"), (1, 0, ""), (1, 1, ""),
        (2, 0, LONG + " ||| w1"), (2, 1, "lost lost lost")]
    assert all(r["warning"] is None and r["error"] is None for r in got)


def test_errors_are_one_row(answers):
    for conv, error in ((2, R.BAD_QUERY), (4, R.UNKNOWN), (6, R.UNKNOWN)):
        (r,) = rows(answers, conv)
        assert (r["id"], r["translation"], r["nbest_words"], r["error"]) == (-1, None, None, error)


def test_words_and_warning(answers):
    got = rows(answers, 3)
    assert len(got) == 6 and {r["warning"] for r in got} == {R.IGNORED_QUERY}
    assert [r["translation"] for r in got[:3]] == [f"plain x.y@z.org {k}" for k in range(3)]
    for r in got:
        one = [{"a": str(r["rank"]), "b": "1"}, {"c": "3"}]
        assert r["nbest_words"] == one * (1 if r["id"] == 0 else 3)
    assert [r["translation"] for r in got[3:]] == [
        " ".join(" ".join(LONG.split()[i:i + 10] + [str(k)]) for i in (0, 10, 20)) for k in range(3)]


def test_ranks_that_a_piece_lacks_go(answers):
    assert [(r["rank"], r["translation"]) for r in rows(answers, 7)] == [(0, "short " + LONG)]


def test_blank_and_null_texts_are_one_empty_line(answers):
    for conv in (5, 8):
        assert [(r["id"], r["rank"], r["translation"], r["nbest_words"], r["error"]) for r in rows(answers, conv)] == [
            (0, k, "", [], None) for k in range(3)]


def test_repeated_ids_and_no_requests(spark, answers):
    assert [r["translation"] for r in rows(answers, 1) if r["nbest_words"] is not None] == ["x 0", "x 1", "x 2"]
    assert R.serve(spark.createDataFrame([], REQUEST_SCHEMA), SYSTEMS, decoder()).collect() == []
    none = R.serve(spark.createDataFrame(ROWS, REQUEST_SCHEMA), {}, decoder()).collect()
    assert {r.error for r in none} == {R.UNKNOWN} and len(none) == len(ROWS)


def test_no_shuffle_and_refused_processors(spark):
    out = R.serve(spark.createDataFrame(ROWS, REQUEST_SCHEMA), SYSTEMS, decoder(), 10)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        R.serve(out, {"aa-en": R.System(P.get_processor("MosesTextProcessor", "aa", "en"))}, decoder())
    with pytest.raises(ValueError):
        R.serve(out, {"aa-en": R.System(n_best=0)}, decoder())
