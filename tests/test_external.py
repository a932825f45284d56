"""The external line filter (X5) against programs that answer at once, late, too little, too much or not at all."""

import sys

import pytest
from pyspark.errors import PythonException

from tessera.operators.external import filter_lines

LATE = "import sys; rows = sys.stdin.readlines(); sys.stdout.writelines('<' + r for r in rows)"
AT_ONCE = "import sys\nfor r in sys.stdin:\n    sys.stdout.write(r[::-1].strip() + '\\n'); sys.stdout.flush()"
NOISY = "import sys\nfor r in sys.stdin:\n    sys.stderr.write('warning ' * 100); sys.stdout.write(r)"


def python(code):
    return [sys.executable, "-c", code]


def corpus(spark, n=6000):
    rows = [(i // 50, i % 50, None if i % 97 == 5 else "" if i % 31 == 0 else f"line {i} é {'x' * (i % 300)}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, line_no int, text string").repartition(3)


@pytest.mark.parametrize("code,change", [(LATE, lambda t: "<" + t), (AT_ONCE, lambda t: t[::-1].strip()), (NOISY, lambda t: t)])
def test_answers_belong_to_their_lines(spark, code, change):
    rows, df = corpus(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")  # more batches than may wait
    try:
        got = {(r["doc_id"], r["line_no"]): r["text"] for r in filter_lines(df, python(code)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(d, n): None if t is None else change(t) for d, n, t in rows}


@pytest.mark.parametrize("code,message", [
    ("import sys; sys.stdout.writelines(sys.stdin.readlines()[1:])", "answered"),
    ("import sys; sys.stdout.write(sys.stdin.read() + 'more\\n')", "answered"),
    ("import sys; sys.stdin.readline(); sys.exit('no model')", "no model"),
    ("import sys; sys.stdin.close()", "answered")])
def test_a_wrong_answer_fails_the_job(spark, code, message):
    _, df = corpus(spark)
    with pytest.raises(PythonException, match=message):
        filter_lines(df, python(code)).collect()


def test_line_breaks_empty_tables_and_limits(spark):
    broken = spark.createDataFrame([(1, 0, "a\nb")], "doc_id long, line_no int, text string")
    with pytest.raises(PythonException, match="line break"):
        filter_lines(broken, ["cat"]).collect()
    assert filter_lines(broken.limit(0), ["no such program"]).collect() == []
    _, df = corpus(spark)
    assert len(filter_lines(df.where("text is not null"), ["cat"]).limit(5).collect()) == 5
