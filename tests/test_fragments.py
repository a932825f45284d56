"""Lines of decoder output that lie together are read together; any order of the rows gives the same blocks."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import nbest, prefix, wrap
from tessera.plans import hyps


def output(rng, n_files):
    """Lines of files of random blocks; some tokens need the map itself, some lines are headers or have no map."""
    rows = []
    for f in range(n_files):
        lines = [""] * rng.randint(0, 2)
        for k in range(rng.randint(1, 9)):
            lines += [f"{k} ||| some text ||| F0= 0 ||| -1"] * rng.randint(0, 1)
            for _ in range(rng.randint(1, 5)):
                w = rng.choice(["Sea", "a\x1fb", "port", "\u0130", "x\u2003y"])
                lines.append(f"{w} |||  " + rng.choice([f"{w} -1 {w.lower()} -2", f"{w} -1 {w} -3", "", f"{w}\u00a0-4 lone"]))
            lines += ["</s> |||  </s> -0.1"] + [" \t"] * rng.randint(1, 2)
        rows += [(f, s, x) for s, x in enumerate(lines[:len(lines) - rng.randint(0, 3)])]
    return rows


def read(df, n_best, **options):
    out = nbest.parse_nbest_words(df, n_best, **options).collect()
    return sorted((r.src_file, r["item"], r["rank"], r.translation, str([list(m.items()) for m in r.nbest_words])) for r in out)


def by_hand(rows, n_best):
    """Blocks of each file read in order; an incomplete last group counts if the last line is not blank."""
    out = []
    for f in sorted({r[0] for r in rows}):
        blocks, open_ = [], False
        for _, _, line in sorted(r for r in rows if r[0] == f):
            s = line.strip()
            if s:
                if not open_:
                    blocks.append([])
                if s.count(" ||| ") != 3:
                    blocks[-1].append(s.partition("|||"))
            open_ = bool(s)
        kept = len(blocks) if open_ else len(blocks) // n_best * n_best
        for k, b in enumerate(blocks[:kept]):
            maps = []
            for _, _, rest in b:
                x = rest.replace("\u2003", " ").replace("\u00a0", " ").split(" ")
                x = [y for y in x if y]
                maps.append(list(dict(zip(x[::2], x[1::2])).items()))
            out.append((f, k // n_best, k % n_best, "".join(t for t, _, _ in b if t != "</s> ").strip(), str(maps)))
    return sorted(out)


@pytest.mark.parametrize("n_best", [1, 2, 3])
def test_rows_in_any_order_give_the_same_blocks(spark, n_best, monkeypatch):
    rows = output(random.Random(n_best), 25)
    want = by_hand(rows, n_best)
    table = spark.createDataFrame(rows, "src_file long, seq long, line string")
    assert read(table.coalesce(1), n_best) == want
    assert read(table.repartition(7, "line"), n_best, bucket_lines=4) == want
    monkeypatch.setattr(nbest, "FRAGMENT_SIZE", 30)
    assert read(table.coalesce(2), n_best, bucket_lines=4) == want


def test_lines_that_lie_together_move_together(spark):
    units = spark.createDataFrame([(f, k, f"W{k} x y") for f in range(3) for k in range(40)], "doc long, item long, text string")
    raw = hyps.words_raw(units, "doc", "item").orderBy("src_file", "seq").coalesce(1)
    parts = nbest.fragments(raw, 2).collect()
    assert raw.count() == 3 * 40 * 2 * 6
    assert len([r for r in parts if r.whole]) == len([r for r in parts if not r.blank]) == 3 * 40 * 2
    assert {(r.w, r.v, r.m) for r in parts if r.block == 0} == {("W0\x1fw0 x y </s>", "-0.5\x1f-1.5 -1.5 -1.5 -0.1", None)}


def test_word_lists_that_their_text_would_not_tell(spark):
    lists = [[{"a": "1", "b": "2"}, {"c": "3"}], [], [{}], [{"a": "1"}, {}], [{"a b": "1"}], [{"a\x1fb": "1"}], [{"": "1"}], [{"a": None}], None]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, x array<map<string,string>>")
    part = df.select("k", F.struct(*wrap.packed_words("x")).alias("p"))
    assert [r.u for r in part.select("k", wrap.unpacked_words(F.col("p")).alias("u")).orderBy("k").collect()] == lists
    assert [r.k for r in part.where("p.m is null").orderBy("k").collect()] == [0, 6, 8]


def test_rows_are_worked_out_once_for_all_levels_of_a_prefix_sum(spark):
    df = spark.range(0, 40).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"), F.expr("id * 3").alias("n"))
    out = prefix.prefix_sum(df, "o", "n", "s", group=["g"])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 40") == 1
    assert {r.o: r.s for r in out.collect()} == {k: 3 * sum(range(k % 2, k, 2)) for k in range(40)}
