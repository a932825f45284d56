"""Truecasing of lines and of a token table against a model applied word by word."""

import random
import re

from tessera.operators import truecase


def corpus(seed):
    rng = random.Random(seed)
    words = ["sea", "Sea", "SEA", "port.", "Port", "iPhone", "IPhone", "now!", "Ünder", "ünder", "x"]
    rows = [(d, n, " ".join(rng.choice(words) for _ in range(rng.randint(0, 14)))) for d in range(6) for n in range(8)]
    return rows + [(9, 0, None), (9, 1, " \t "), (9, 2, "New end. New Sea"), (9, 2, "Ünder now! SEA")]       # one line twice


def by_hand(rows, model):
    out = {}
    for d, n, text in rows:
        toks = (text or "").split()
        for k, t in enumerate(toks):
            best, forms = model.get(t.lower(), (t, [t]))
            first = k == 0 or re.search(r"[.!?:]$", toks[k - 1])
            out.setdefault((d, n), []).append((k, best if first or t not in forms else t))
        out.setdefault((d, n), [])
    return {k: " ".join(t for _, t in sorted(v)) for k, v in out.items()}


def test_lines_and_tokens_are_cased_alike(spark):
    rows = corpus(1)
    lines = spark.createDataFrame(rows, "doc_id long, line_no long, text string")
    for model in (truecase.case_model(truecase.token_table(lines)),            # no change but of initial tokens
                  truecase.case_model(truecase.token_table(lines.where("doc_id < 2"))),
                  spark.createDataFrame([("sea", "SEA", ["SEA"]), ("x", "X", ["X", "y"])], "lc string, best string, forms array<string>"),
                  spark.createDataFrame([], "lc string, best string, forms array<string>")):
        want = by_hand(rows, {r.lc: (r.best, r.forms) for r in model.collect()})
        for out in (truecase.truecase_lines(lines, model), truecase.truecase(truecase.token_table(lines), model)):
            assert {(r.doc_id, r.line_no): r.text for r in out.collect()} == want
            assert out.count() == len(want)


def test_lines_move_whole_and_only_changed_tokens_beside_them(spark):
    lines = spark.createDataFrame([(d, 0, "The sea and the port and the sea") for d in range(20)], "doc_id long, line_no long, text string")
    out = truecase.truecase_lines(lines, truecase.case_model(truecase.token_table(lines)))
    plan = out._jdf.queryExecution().optimizedPlan()
    moved = [p for p in plan.toString().split("\n") if "Aggregate [doc_id" in p]
    assert len(moved) == 1 and "lc" not in moved[0]
    assert {r.text for r in out.collect()} == {"the sea and the port and the sea"}
