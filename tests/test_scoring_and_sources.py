"""Scorers against brute force; folder source; routing errors."""

import math
import os
import re
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import routing, scoring
from tessera.sources.tables import folder_listing, read_folder


def tok13a(s):
    for a, b in (("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"),
                 ("&lt;", "<"), ("&gt;", ">")):
        s = s.replace(a, b)
    s = f" {s} "
    s = re.sub(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 ", s)
    s = re.sub(r"([^0-9])([\.,])", r"\1 \2 ", s)
    s = re.sub(r"([\.,])([^0-9])", r" \1 \2", s)
    s = re.sub(r"([0-9])(-)", r"\1 \2 ", s)
    return s.split()


def bleu_brute(hyps, refs):
    correct, total = [0] * 4, [0] * 4
    sys_len = ref_len = 0
    for h, r in zip(hyps, refs):
        th, tr = tok13a(h), tok13a(r)
        sys_len += len(th)
        ref_len += len(tr)
        for n in range(1, 5):
            ch = Counter(tuple(th[i:i + n]) for i in range(len(th) - n + 1))
            cr = Counter(tuple(tr[i:i + n]) for i in range(len(tr) - n + 1))
            correct[n - 1] += sum(min(c, cr[g]) for g, c in ch.items())
            total[n - 1] += sum(ch.values())
    prec, k = [], 1.0
    for n in range(4):
        if total[n] == 0:
            prec.append(0.0)
        elif correct[n] == 0:
            k *= 2
            prec.append(100.0 / (k * total[n]))
        else:
            prec.append(100.0 * correct[n] / total[n])
    bp = 1.0 if sys_len >= ref_len else (math.exp(1 - ref_len / sys_len) if sys_len else 0.0)
    return 0.0 if min(prec) <= 0 else bp * math.exp(sum(math.log(p) for p in prec) / 4)


def test_corpus_bleu_matches_brute_force(spark):
    hyps = ["The cat sat on the mat.", "It rains, 3.5 mm today!", "a b c d e f", "short"]
    refs = ["The cat is on the mat.", "It rains, 3.5 mm today.", "a b c d x f", "a much longer reference"]
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(zip(hyps, refs))], "k long, hyp string, ref string")
    got = scoring.corpus_bleu(df, [], ["k"]).first()
    assert got.bleu == pytest.approx(bleu_brute(hyps, refs), abs=1e-5)
    assert got.sys_len == sum(len(tok13a(h)) for h in hyps)


def test_query_metric(spark):
    rows = [(0, "apple and banana apple", "apple ||| banana"), (1, "nothing", ""), (2, "kiwi", "kiwi ||| pear")]
    df = spark.createDataFrame(rows, "k long, hyp string, query string").withColumn("g", F.lit(0))
    got = scoring.query_term_scores(df, ["g"]).first()
    # sentence 0: inserted 3 of 2 expected → 0.5; sentence 2: 1 of 2 → 0.5; sentence 1 skipped
    assert (got.inserted, got.expected, got.score) == (4, 4, 0.5)


def test_read_folder_keeps_layout_and_cr(spark):
    d = tempfile.mkdtemp(prefix="tessera-folder-")
    os.makedirs(f"{d}/sub")
    with open(f"{d}/a.txt", "w") as f:
        f.write("one\r two\nthree\n")
    with open(f"{d}/sub/b.txt", "w") as f:
        f.write("last line without newline")
    open(f"{d}/empty.txt", "w").close()
    lines = {(r.doc, r.line_no): r.text for r in read_folder(spark, d).collect()}
    assert lines == {("a.txt", 0): "one two", ("a.txt", 1): "three", ("sub/b.txt", 0): "last line without newline",
                     ("empty.txt", 0): ""}
    docs = {r.doc: r.length for r in folder_listing(spark, d).collect()}
    assert docs["empty.txt"] == 0 and len(docs) == 3


def test_routing_errors(spark):
    reg = routing.Registry(installed=["deen"])
    reg.system_to_langs.update({"x1": [("es", "en")], "x2": [("es", "en")]})
    req = spark.createDataFrame([("de", "en", "text", False, None), ("es", "en", "text", False, None),
                                 ("zz", "en", "text", False, None), ("en", "kk", "text", False, None)],
                                "src_lang string, tgt_lang string, type string, query boolean, system string")
    out = {(r.src_lang, r.tgt_lang): (r.system, r.error) for r in routing.route(req, reg).collect()}
    assert out[("de", "en")] == ("deen", None)
    assert out[("es", "en")][1].startswith("ambiguous")
    assert out[("zz", "en")][1].startswith("unrecognized")
    assert out[("en", "kk")] == ("kkenru", None)


def test_tags_side_file_and_vocab(spark):
    from tessera.operators import placeholders as PH
    from tessera.sources import sinks
    from tessera.sources.tables import read_tags, read_vocab, require_rows
    d = tempfile.mkdtemp(prefix="tessera-sink-")
    df = spark.createDataFrame([("a", 0, "mail x@y.org now")], "doc string, line_no long, text string")
    ext = PH.extract_placeholders(df, "text", "masked", "tags")
    sinks.write_tags(ext, f"{d}/tags")
    back = read_tags(spark.read.parquet(f"{d}/tags"), "tags").first()
    assert [(t.placeholder, t.original) for t in back.tags] == [("[EML0]", "x@y.org")]
    with open(f"{d}/vocab.txt", "w") as f:
        f.write("the 10\ncat 2\nsat 5\n")
    assert {r.token for r in read_vocab(spark, f"{d}/vocab.txt", 5).collect()} == {"the", "sat"}
    with pytest.raises(ValueError):
        require_rows(df.filter("false"))


def test_big_file_line_numbers_across_splits(spark):
    from tessera.sources.tables import read_big_file_lines
    d = tempfile.mkdtemp(prefix="tessera-big-")
    lines = [f"line {i} " + "x" * (i % 37) for i in range(3000)]
    with open(f"{d}/big.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    with open(f"{d}/small.txt", "w") as f:
        f.write("a\r\nb")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_big_file_lines(spark, d)
        assert df.rdd.getNumPartitions() > 10
        got = {(r.doc.rsplit("/", 1)[-1], r.line_no): r.text for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {k: v for k, v in got.items() if k[0] == "big.txt"} == {("big.txt", i): t for i, t in enumerate(lines)}
    assert got[("small.txt", 0)] == "a" and got[("small.txt", 1)] == "b"


def test_bleu_clips_by_the_best_reference_and_scores_one_best(spark):
    hyps = spark.createDataFrame([(0, 0, "a a b"), (0, 1, "x y z"), (1, 0, None), (1, 1, "a")], "k int, rank int, hyp string")
    best = scoring.first_rank(hyps)
    assert sorted((r.k, r.hyp) for r in best.collect()) == [(0, "a a b"), (1, None)]
    refs = spark.createDataFrame([(0, "a c", "a a d e"), (1, "b", "")], "k int, r1 string, r2 string")
    got = scoring.corpus_bleu(best.join(refs, "k"), [], ["k"], refs=("r1", "r2")).first()
    assert (got.sys_len, got.ref_len) == (3, 2)      # lengths 2 and 4 are equally close: the shorter; then 0
    assert got.p1 == round(100 * 2 / 3, 6) and got.p2 == 50.0
