"""The line stream: pieces in any order, waiting pieces, and a batch that is run again."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.functions import processors as P
from tessera.functions import text as T
from tessera.streaming import lines as L

WORDS = " ".join(f"w{i}" for i in range(35))
LINES = [("d", 0, WORDS), ("d", 1, ""), ("d", 2, "see x.y@z.org now"), ("e", 0, None), ("e", 1, WORDS + " end"), (None, 0, "no doc")]
SCHEMA = "doc_id string, line_no long, text string"


def decoder():
    def factory():
        return lambda texts: [[t, t.upper(), "third"] for t in texts]
    return factory


def want():
    out = {}
    for d, i, t in LINES:
        for r in range(2):
            s = t or ""
            out[d, i, r] = s.upper().replace("X.Y@Z.ORG", "x.y@z.org") if r else s
    return out


def got(df):
    rows = [((r.doc_id, r.line_no, r.rank), " ".join(r.translation.split())) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


@pytest.fixture
def source(spark):
    """One decoded piece per file, the last pieces first, so that lines wait over several batches."""
    base = tempfile.mkdtemp(prefix="tessera-lines-")
    pieces = L.send_pieces(spark.createDataFrame(LINES, SCHEMA), extract_tags=True, max_length=10)
    decoded = L.decode_stream(pieces, decoder(), 2).cache()
    for k, number in enumerate(sorted({r.piece_no for r in decoded.select("piece_no").collect()}, reverse=True)):
        part = decoded.where(F.col("piece_no") == number).coalesce(1)
        if number == 3:
            part = part.unionByName(part).coalesce(1)       # delivered twice
        part.write.mode("append").parquet(f"{base}/in")
        for f in os.listdir(f"{base}/in"):                  # the file source takes the oldest first
            if f.startswith("part-") and not os.path.exists(f"{base}/{f}"):
                open(f"{base}/{f}", "w").close()
                os.utime(f"{base}/in/{f}", (1000 + k * 10, 1000 + k * 10))
    return base, decoded.schema


def stream(spark, source):
    base, schema = source
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")


def test_lines_wait_for_all_their_pieces(spark, source):
    base, _ = source
    L.collect_lines(stream(spark, source), f"{base}/out", f"{base}/ckpt", n_best=2)
    out = spark.read.parquet(f"{base}/out")
    assert got(out) == want()
    batches = {(r.doc_id, r.line_no): r.batch for r in out.collect()}
    assert set(batches.values()) == {3}                       # piece 0 of every line came last
    assert L.waiting_pieces(spark, f"{base}/ckpt").count() == 0
    assert sorted(os.listdir(f"{base}/ckpt-waiting")) == ["batch=2", "batch=3"]


@pytest.mark.parametrize("stop_at", ["out/batch=1", "ckpt-waiting/batch=1", "ckpt-waiting/batch=3"])
def test_a_killed_batch_is_run_again(spark, source, monkeypatch, stop_at):
    base, _ = source
    write = L._write

    def failing(df, path):
        write(df, path)
        if path.endswith(stop_at):
            raise RuntimeError("killed")
    monkeypatch.setattr(L, "_write", failing)
    with pytest.raises(Exception, match="killed"):
        L.collect_lines(stream(spark, source), f"{base}/out", f"{base}/ckpt", n_best=2)
    monkeypatch.setattr(L, "_write", write)
    L.collect_lines(stream(spark, source), f"{base}/out", f"{base}/ckpt", n_best=2)
    assert got(spark.read.parquet(f"{base}/out")) == want()


def test_more_input_goes_on(spark):
    base = tempfile.mkdtemp(prefix="tessera-lines-")
    proc = P.TextProcessor("tag", pre_piece=lambda p: T.language_tag(p, F.lit("en")), post=lambda c: F.regexp_replace(c, "(?i)<2en> ?", ""))
    for part in (LINES[:3], LINES[3:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").json(f"{base}/in")
        read = spark.readStream.schema(SCHEMA).json(f"{base}/in")
        out = L.translate_stream(spark, read, base, decoder(), 2, processor=proc, extract_tags=True, max_length=10)
    assert got(out) == want()


def test_unfinished_lines_stay(spark, source):
    base, schema = source
    spark.read.schema(schema).parquet(f"{base}/in").where("piece_no > 0").write.parquet(f"{base}/some")
    some = spark.readStream.schema(schema).parquet(f"{base}/some")
    L.collect_lines(some, f"{base}/out2", f"{base}/ckpt2", n_best=2)
    assert spark.read.parquet(f"{base}/out2").count() == 0
    assert {(r.doc_id, r.line_no) for r in L.waiting_pieces(spark, f"{base}/ckpt2").collect()} == {("d", 0), ("e", 1)}
    with pytest.raises(ValueError):
        L.collect_lines(some, f"{base}/out3", f"{base}/ckpt3", processor=P.get_processor("MosesTextProcessor", "en", "en"))
