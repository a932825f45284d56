"""Each pipeline stage against brute force, on a whole small table."""

import os

import corpus_pipeline
from tessera.llm import decontaminate, mixing, simhash, toxicity
from tessera.llm.common import staged, table
from tests.llm.helpers import prose
from tests.llm.test_dedup import brute_fingerprint, smallest_reachable
from tests.llm.test_filters import contained

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark):
    docs = table(spark, SF, "documents")
    seen = {"documents": docs.toPandas()}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), f"test-{name}")
        seen[name] = docs.toPandas()
        assert list(seen[name].columns) == [*seen["documents"].columns, *(["copies"] if name == "mixing" else [])]
    before = dict(zip([*seen][1:], [*seen.values()]))

    scores = {x["doc_id"]: x["predicted"] for x in toxicity.classify(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()}
    assert set(seen["toxicity"].doc_id) == {d for d, p in scores.items() if not p}

    groups = before["exact_dedup"].fillna({"text": ""}).groupby("text").doc_id.max()
    assert sorted(seen["exact_dedup"].doc_id) == sorted(groups)

    docs = before["near_dedup"]
    fps = [brute_fingerprint(t) for t in docs.text]
    roots = smallest_reachable(docs.doc_id.tolist(), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    assert sorted(seen["near_dedup"].doc_id) == sorted(set(roots.values()))

    items = table(spark, SF, "benchmark").toPandas()
    clean = [d for d, t in zip(before["decontamination"].doc_id, before["decontamination"].text)
             if not any(n and s >= 0.8 * n for s, n in (contained(t, x) for x in items.text))]
    assert sorted(seen["decontamination"].doc_id) == sorted(clean)
    assert len(clean) < len(before["decontamination"])

    plan = mixing.sample_plan(spark.createDataFrame(before["mixing"])).toPandas()
    assert sorted(zip(seen["mixing"].doc_id, seen["mixing"].copies)) == sorted(zip(plan[plan.kept].doc_id, plan[plan.kept].copies))
    assert plan.kept.mean() > 0.85
    assert decontaminate.SHINGLE == 5 and decontaminate.THRESHOLD == 0.8


def test_run_returns_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == [*table(spark, SF, "documents").columns, "copies"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]


def test_rows_leave_by_row_and_not_by_id(spark):
    near, clean, bench = prose(1, 200), prose(2, 200), prose(3, 40)
    docs = [(1, near), (5, near + "!"), (5, clean), (None, near.upper()), (None, prose(4, 200)), (7, prose(5, 200)), (7, prose(5, 200) + ".")]
    left = simhash.drop_near_copies(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((x["doc_id"], x["text"][:20]) for x in left if x["doc_id"]) == sorted([(1, near[:20]), (5, clean[:20]), (7, docs[5][1][:20])])
    assert [x["text"] for x in left if x["doc_id"] is None] == [docs[4][1]]

    items = spark.createDataFrame([(1, bench)], "item_id long, text string")
    docs = [(1, near + " " + bench), (1, clean), (None, bench + " " + clean), (None, near), (2, clean)]
    left = decontaminate.drop_leaked(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert sorted(map(tuple, left), key=repr) == sorted([docs[1], docs[3], docs[4]], key=repr)
