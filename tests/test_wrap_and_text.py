"""Wrap/unwrap, placeholders, normalisation and small text functions."""

from pyspark.sql import functions as F

from tessera.functions import normalize as N
from tessera.functions import text as T
from tessera.operators import decode, placeholders as PH, prefix, wrap


def _lines(spark, texts):
    return spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "doc_id long, line_no long, text string")


def test_wrap_boundaries(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[:200]), " ".join(words[:201]), " ".join(words), "", "  a   b  "]
    pieces = wrap.wrap_lines(_lines(spark, texts)).orderBy("line_no", "piece_no").collect()
    by_line = {}
    for p in pieces:
        by_line.setdefault(p.line_no, []).append(p)
    assert [len(by_line[i]) for i in range(5)] == [1, 2, 2, 1, 1]
    assert by_line[1][1].text == "w200"
    assert by_line[2][0].text == " ".join(words[:200]) and by_line[2][1].text == " ".join(words[200:])
    assert by_line[3][0].is_empty and by_line[3][0].text == ""
    assert by_line[4][0].text == "a   b"                     # short line: inner spacing kept


def test_unwrap_roundtrip_and_zip_truncation(spark):
    words = [f"w{i}" for i in range(450)]
    texts = [" ".join(words), "x  y", ""]
    pieces = wrap.wrap_lines(_lines(spark, texts))
    out = {(r.line_no, r.rank): r.translation for r in wrap.unwrap_pieces(decode.echo_decode(pieces, 2)).collect()}
    assert out[(0, 0)] == " ".join(words) and out[(1, 0)] == "x  y" and out[(2, 0)] == ""
    assert out[(1, 1)] == "x  y".lower()
    # piece 1 of line 0 has only one rank: rank 1 of that line must disappear (zip truncation)
    hyps = decode.echo_decode(pieces, 2).filter(~((F.col("line_no") == 0) & (F.col("piece_no") == 1)
                                                   & (F.col("rank") == 1)))
    got = {(r.line_no, r.rank) for r in wrap.unwrap_pieces(hyps).collect()}
    assert (0, 0) in got and (0, 1) not in got


def test_batch_decode_hook(spark):
    pieces = wrap.wrap_lines(_lines(spark, ["hello world", "foo"]))

    def factory():
        return lambda texts: [[t.upper(), t[::-1]] for t in texts]
    out = decode.batch_decode(pieces, factory, n_best=2, keys=["doc_id", "line_no", "piece_no"])
    rows = {(r.line_no, r.rank): r.translation for r in out.collect()}
    assert rows[(0, 0)] == "HELLO WORLD" and rows[(1, 1)] == "oof"


def test_placeholders_extract_and_reinsert(spark):
    texts = ["mail a.b@x.org and c@y.net now", "a.b@x.org", "see <b>bold</b> www.example.com/x ok @handle"]
    df = PH.extract_placeholders(_lines(spark, texts), "text", "masked", "tags")
    rows = {r.line_no: r for r in df.collect()}
    assert rows[0].masked == "mail  [EML0]  and  [EML1]  now"
    assert [t.original for t in rows[0].tags] == ["a.b@x.org", "c@y.net"]
    assert rows[1].masked.strip() == "[EML0]"                           # address at line start and end
    kinds = [t.placeholder for t in rows[2].tags]
    assert kinds[:2] == ["[TAG0]", "[TAG1]"] and "[URL0]" in kinds and "[HANDLE0]" in kinds
    # decoder lost [EML1]: its original is appended at the end
    lost = df.filter("line_no = 0").select(PH.reinsert_column(F.lit("mail [EML0] now"), F.col("tags")).alias("r"))
    assert lost.first().r == "mail a.b@x.org now c@y.net"


def test_normalize_chars(spark):
    texts = ["café‌  naïve", "a\tb c", "йога", "3.14 12:30 %5 x,y '' ok!"]
    df = N.normalize_corpus(_lines(spark, texts), "en", out="n", lowercase=True)
    got = {r.line_no: r.n for r in df.collect()}
    assert got[0] == "cafe naive"
    assert got[1] == "abc"                                               # tab and NBSP vanish (non-printable)
    assert got[2] == "йoгa".replace("o", "о").replace("a", "а")
    punct = N.normalize_corpus(_lines(spark, texts), "en", out="n", remove_punct=True).collect()
    assert {r.line_no: r.n for r in punct}[3] == "3.14 12:30 %5 xy ok"


def test_cap_repetitions_and_decoders(spark):
    df = spark.createDataFrame([("mannnner!!!!",)], "t string")
    assert df.select(N.cap_repetitions(F.col("t"), 2)).first()[0] == "manner!!"
    df = spark.createDataFrame([("the qu@@ ick fo@@ x@@",)], "t string")
    assert df.select(T.bpe_decode(F.col("t"))).first()[0] == "the quick fox"
    df = spark.createDataFrame([("▁the ▁qu ick",)], "t string")
    assert df.select(T.spm_decode(F.col("t"))).first()[0] == "the quick"


def test_prefix_sum_partition_invariant(spark):
    rows = [(g, i, (i * 7 + g) % 5) for g in range(3) for i in range(50)]
    df = spark.createDataFrame(rows, "g long, o long, v long")
    expect = {}
    for g in range(3):
        acc = 0
        for i in range(50):
            expect[(g, i)] = acc
            acc += (i * 7 + g) % 5
    for width in (1, 7, 1 << 16):
        got = {(r.g, r.o): r.s for r in prefix.prefix_sum(df.repartition(3), "o", "v", "s", ["g"], width).collect()}
        assert got == expect


def test_prefix_sum_of_sparse_and_negative_orders(spark):
    import random
    r = random.Random(2)
    rows = sorted((r.randrange(-2 ** 62, 2 ** 62), r.randrange(5)) for _ in range(500)) + [(2 ** 62 + i, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "o long, v long").repartition(3)
    got = {x.o: x.s for x in prefix.prefix_sum(df, "o", "v", "s").collect()}
    want, total = {}, 0
    for o, v in rows:
        want[o], total = total, total + v
    assert got == want


def test_checkpoint_folder_must_be_shared(spark, monkeypatch):
    import pytest
    from tessera import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_wrapping_splits_a_line_once(spark):
    lines = spark.range(3).select(F.lit(0).alias("doc_id"), F.col("id").alias("line_no"),
                                  F.when(F.col("id") < 2, F.repeat(F.lit("a "), (F.col("id") * 60).cast("int"))).alias("text"))
    pieces = wrap.wrap_lines(lines, max_length=25)
    # no filter before the explode that splits each line again for each of its pieces
    assert pieces._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    got = sorted((p.line_no, p.piece_no, p.n_pieces, p.text) for p in pieces.collect())
    assert got == [(0, 0, 1, ""), *((1, i, 3, " ".join("a" * n)) for i, n in enumerate((25, 25, 10))), (2, 0, 1, None)]
