"""Big files by splits, hidden files, blanks in paths and extra sources in the folder job."""

import glob
import json
import os
import tempfile

import pytest

from tessera.operators.translate import translate_folder, translate_lines
from tessera.sources.tables import folder_listing, read_folder


@pytest.fixture(scope="module")
def folder():
    d = tempfile.mkdtemp(prefix="tessera big+in ")
    os.makedirs(f"{d}/in a/b%20c")
    os.makedirs(f"{d}/_stages")
    files = {"in a/big one.txt": "\n".join(f"line {i} " + "é" * (i % 41) + "\r" * (i % 2) for i in range(4000)) + "\n\n",
             "in a/b%20c/x+y.txt": "small\n" + " ".join(f"w{i}" for i in range(450)), "empty.txt": "", "last.txt": "a\n\nb"}
    for name, text in {**files, "_SUCCESS": "", ".hidden": "x", "_stages/part-0": "x"}.items():
        with open(f"{d}/{name}", "w", newline="") as f:
            f.write(text)
    return d, files


def lines_of(text):
    parts = text.replace("\r", "").split("\n")
    return parts[:-1] if parts[-1] == "" and len(parts) > 1 else parts


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("big", [1, 5000, 1 << 30])
def test_every_file_by_its_plain_name(spark, folder, small_splits, big):
    d, files = folder
    got = {(r.doc, r.line_no): r.text for r in read_folder(spark, d, big=big).collect()}
    assert got == {(n, i): line for n, t in files.items() for i, line in enumerate(lines_of(t))}
    assert {r.doc: r.length for r in folder_listing(spark, d).collect()} == {n: len(t.encode()) for n, t in files.items()}


def test_a_big_file_is_many_tasks(spark, folder, small_splits):
    assert read_folder(spark, folder[0], glob="big*", big=5000).rdd.getNumPartitions() > 10


def test_job_gives_the_same_rows_either_way(spark, folder, small_splits):
    d, files = folder
    found = []
    for big in (5000, 1 << 30):
        out = translate_folder(spark, d, tempfile.mkdtemp(prefix="tessera-out-"), n_best=2, big=big)
        rows = {}
        for name in files:
            shown = name.replace("%", "%25").replace("/", "%2F")  # Spark's escape of partition values
            for part in sorted(glob.glob(f"{glob.escape(out)}/doc={glob.escape(shown)}/part-*")):
                with open(part) as f:
                    rows.setdefault(name, []).extend(json.loads(x) for x in f)
        found.append(rows)
    assert found[0] == found[1] and set(found[0]) == set(files)
    want = [" ".join(x.split(" ")).strip() for x in lines_of(files["in a/b%20c/x+y.txt"])]
    assert [r["translation"] for r in found[0]["in a/b%20c/x+y.txt"]][::2] == want


def test_extra_sources_reach_the_decoder(spark):
    long = " ".join(f"w{i}" for i in range(450))
    main = spark.createDataFrame([("a", 0, "one"), ("a", 1, long), ("b", 0, "two")], "doc string, line_no long, text string")
    extra = spark.createDataFrame([("a", 0, "uno "), ("a", 1, "lang"), ("c", 0, "x")], "doc string, line_no long, text string")

    def factory():
        return lambda texts, others: [[f"{t.split(' ')[0]}+{o}"] for t, o in zip(texts, others)]
    out = {(r.doc, r.line_no): r.translation for r in translate_lines(main, decoder_factory=factory, extras=[extra]).collect()}
    assert out == {("a", 0): "one+uno", ("a", 1): "w0+lang w200+lang w400+lang", ("b", 0): "two+"}
    with pytest.raises(ValueError):
        translate_lines(main, extras=[extra])
