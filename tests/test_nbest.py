"""Decoder-output parsers: fixtures of our own, and a checker that splits the
text at runs of blank lines and deals the blocks out in groups."""

import re

import pytest
from conftest import raw_table

from tessera.operators import nbest

# Token lines are "token ||| alternative score ...", with the token's own space before the bars.
HARBOUR = "\n".join(["harbour |||  harbour -0.25 port -1.75", "lights |||  lights -0.5", "</s> |||  </s> -0.125"])
FERRY = "\n".join(["ferry |||  ferry -1 boat -2 ferry -3", "</s> |||  </s> -0.5"])
TICKET = "\n".join(["late |||  late -0.1", "ticket |||  ticket -0.2 fare -0.9 pass -1.1", "office |||  office -0.3", "</s> |||  </s> -0.4"])
NOTHING = "</s> |||  of -2 at -2.5 in -3"


def head(number, text, score):
    return f"{number} ||| {text} ||| Len= 1 ||| {score}"


def blocks_of(text):
    """Text and alternatives of each block of non-blank lines."""
    out = []
    for block in re.split(r"\n(?:\s*\n)+", text.strip("\n")):
        body = [re.split(r"\|\|\|", x.strip(), maxsplit=1) for x in block.split("\n") if x.strip() and x.count(" ||| ") < 3]
        pairs = [re.findall(r"(\S+)\s+(\S+)", rest) for _, rest in body]
        out.append(("".join(t for t, _ in body if t != "</s> ").strip(), [dict(p) for p in pairs]))
    return out


def expected(text, n_best):
    """Blocks in groups; an incomplete last group counts only if no blank line closes it."""
    blocks = blocks_of(text)
    closed = text.split("\n")[-1].strip() == "" and text.rstrip(" ").endswith("\n\n")
    whole = len(blocks) // n_best * n_best
    kept = blocks[:whole] if closed else blocks
    return [(k // n_best, k % n_best, t, w) for k, (t, w) in enumerate(kept)]


def parsed(spark, text, n_best, bucket_lines=1 << 20, **options):
    df = nbest.parse_nbest_words(raw_table(spark, text), n_best=n_best, bucket_lines=bucket_lines, **options)
    return [(r.item, r.rank, r.translation, [dict(m) for m in r.nbest_words]) for r in df.orderBy("item", "rank").collect()]


def joined(blocks, gap="\n\n", end="\n\n"):
    return gap.join(blocks) + end


@pytest.mark.parametrize("gap", ["\n\n", "\n \t\n", "\n\n\n\n"])
def test_blocks_between_blank_lines(spark, gap):
    text = "\n\n" + joined([HARBOUR, TICKET, FERRY], gap)
    got = parsed(spark, text, 1)
    assert got == expected(text, 1)
    assert [g[2] for g in got] == ["harbour lights", "late ticket office", "ferry"]
    assert got[0][3] == [{"harbour": "-0.25", "port": "-1.75"}, {"lights": "-0.5"}, {"</s>": "-0.125"}]


def test_a_repeated_alternative_keeps_its_last_score(spark):
    assert parsed(spark, joined([FERRY]), 1)[0][3][0] == {"ferry": "-3", "boat": "-2"}


def test_headers_and_groups(spark):
    text = joined([head(0, "harbour lights", -1) + "\n" + HARBOUR, head(0, "ferry", -2) + "\n" + FERRY,
                   head(1, "late", -3) + "\n" + TICKET, head(1, "none", -4) + "\n" + NOTHING])
    got = parsed(spark, text, 2)
    assert got == expected(text, 2)
    assert [g[:3] for g in got] == [(0, 0, "harbour lights"), (0, 1, "ferry"), (1, 0, "late ticket office"), (1, 1, "")]
    assert parsed(spark, text, 2, n_items=1) == got[:2]


def test_no_words_and_no_last_line(spark):
    got = parsed(spark, NOTHING, 1)
    assert got == expected(NOTHING, 1) == [(0, 0, "", [{"of": "-2", "at": "-2.5", "in": "-3"}])]


def test_an_incomplete_last_group(spark):
    closed = joined([HARBOUR, FERRY, TICKET])
    assert [g[:2] for g in parsed(spark, closed, 2)] == [(0, 0), (0, 1)]
    unclosed = joined([HARBOUR, FERRY, TICKET], end="")
    assert parsed(spark, unclosed, 2) == expected(unclosed, 2)
    assert [g[:2] for g in parsed(spark, unclosed, 2)] == [(0, 0), (0, 1), (1, 0)]


@pytest.mark.parametrize("bucket_lines", [2, 3, 5])
def test_buckets_do_not_change_blocks(spark, bucket_lines):
    text = joined([HARBOUR, FERRY, TICKET, NOTHING] * 4, "\n\n\n")
    assert parsed(spark, text, 2, bucket_lines) == expected(text, 2)


def nbest_rows(spark, text, n_best, **options):
    df = nbest.parse_nbest(raw_table(spark, text), n_best=n_best, **options)
    return [tuple(r)[1:] for r in df.orderBy("item", "rank").collect()]


def test_fields_come_from_both_ends(spark):
    text = "\n".join([head(0, "left ||| right", -2), head(0, "a ||| b ||| c", -1), head(1, "", -3), head(1, "x", -4), head(2, "lone", -5)])
    got = nbest_rows(spark, text, 2)
    assert got == [(0, 0, "left ||| right", "Len= 1", "-2"), (0, 1, "a ||| b ||| c", "Len= 1", "-1"),
                   (1, 0, "", "Len= 1", "-3"), (1, 1, "x", "Len= 1", "-4")]
    best = nbest.top_k(nbest.parse_nbest(raw_table(spark, text), n_best=2), 1).orderBy("item").collect()
    assert [(r.translation, r.rank) for r in best] == [("a ||| b ||| c", 0), ("", 0)]
    assert nbest_rows(spark, text, 1, n_items=2) == [(0, 0, "left ||| right", "Len= 1", "-2"), (1, 0, "a ||| b ||| c", "Len= 1", "-1")]


def test_plain_lines_are_items_of_their_own(spark):
    assert nbest_rows(spark, "one line\ntwo | lines\n\n", 2) == [(0, 0, "one line", None, None), (1, 0, "two | lines", None, None), (2, 0, "", None, None)]


def test_one_file_with_most_lines_joins_nothing(spark):
    rows = spark.range(3000).selectExpr("int(id % 100 = 0) as src_file", "id as seq", "concat(id, ' ||| t ||| F ||| -1') as line")
    plan = nbest.parse_nbest(rows, n_best=2)._jdf.queryExecution().toString()
    assert "Join" not in plan
