"""URL filter, decontamination, toxicity and mixing against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import decontaminate, mixing, toxicity, url_filter
from tests.llm.helpers import WORDS, prose


def judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    host = host.lower()
    fits = [(h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
    return host, path, best[0], "block" if (best[0], "block") in fits else best[1]


def test_url_cascade_is_exact(spark):
    r = random.Random(3)
    hosts = [f"{r.choice('abc')}{i}.{r.choice(['com', 'net'])}" for i in range(400)]
    rules = sorted({(r.choice(hosts), r.choice(["/", "/en/", "/en/x", ""]), r.choice(["allow", "block"])) for _ in range(250)})
    urls = [f"http://{r.choice(['', 'www.', 'm.x.'])}{r.choice(hosts).upper() if r.random() < .3 else r.choice(hosts)}"
            f"{r.choice(['', '/', '/en/', '/en/x?q', '/fr#a'])}" for _ in range(3000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, action string")).collect()
    assert {x["page_id"]: tuple(x)[1:] for x in got} == {i: judge(u, rules) for i, u in enumerate(urls)}


def test_cascade_encodes_false_positives(spark):
    listed = spark.range(0, 300).select(F.concat(F.lit("k"), "id").alias("key"))
    universe = spark.range(0, 2000).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = url_filter.build_cascade(listed, universe, "x")
    assert len(cascade.levels) > 2
    assert sum(lv.bits for lv in cascade.levels) < 300 * 40
    out = universe.select("key", *[c.alias(n) for n, c in cascade.columns().items()]).select("key", cascade.holds(F.col("key")).alias("in"))
    assert {r["key"] for r in out.collect() if r["in"]} == {f"k{i}" for i in range(300)}


def contained(text, item):
    words, own = (decontaminate.words_of((x or "").encode()) for x in (text, item))
    n = min(5, len(own))
    a, b = ({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set() for w in (own, words))
    return len(a & b), len(a)


def test_containment_search_loses_nothing(spark):
    r = random.Random(8)
    items = [(i, prose(1000 + i, r.choice([1, 2, 3, 4, 5, 8, 20, 40, 90]))) for i in range(40)]
    items += [(100, items[3][1]), (101, items[3][1] + "."), (102, "")]
    docs = []
    for d in range(200):
        text = prose(d, r.choice([0, 10, 300])).split()
        for _ in range(r.randint(0, 2)):
            words = r.choice(items[:40])[1].split()
            for _ in range(r.choice([0, 0, 1, 2])):
                words[r.randrange(len(words))] = r.choice(WORDS)
            words = words[:max(1, int(len(words) * r.choice([1, 1, 0.85, 0.7])))]
            at = r.randint(0, len(text))
            text[at:at] = [w.upper() if r.random() < 0.1 else w for w in words]
        docs.append((d, r.choice([" ", ", ", "\n"]).join(text)))
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                              block=300).collect()
    want = {(d, i): contained(t, x) for d, t in docs for i, x in items}
    assert {(x["doc_id"], x["item_id"]): (x["shared"], x["shingles"]) for x in got} == {k: v for k, v in want.items() if v[1] and v[0] >= 0.8 * v[1]}
    assert len(got) > 30 and any(v[1] == 1 and v[0] and len(dict(docs)[d].split()) > 20 for (d, _), v in want.items())


def test_items_of_one_text_are_one_search(spark):
    items = spark.createDataFrame([(i, "same short item") for i in range(500)] + [(1000, "other words of another test item")], "item_id long, text string")
    rows, blocks = decontaminate.item_blocks(items, "item_id", "text", block=1)
    assert rows.count() == 501 and sum(b.count() for b in blocks) == 2
    docs = spark.createDataFrame([(7, "the same, short ITEM here"), (8, "same short")], "doc_id long, text string")
    assert sorted((x["doc_id"], x["item_id"]) for x in decontaminate.leaks(docs, items).collect()) == [(7, i) for i in range(500)]


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(1)
    docs, labels = [], []
    for i in range(1500):
        toxic = int(r.random() < 0.15)
        words = prose(i, r.randint(20, 200)).split()
        for _ in range(max(1, len(words) // 20) if toxic else 0):
            words[r.randrange(len(words))] = r.choice(["vilefool", "Grubworm", "dunderhead"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), labels


def test_toxicity_on_held_out_rows(spark, labelled):
    docs, labels = labelled
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {x["doc_id"]: x for x in toxicity.classify(docs, table).collect()}
    held = [(got[i]["predicted"], t) for i, _, t in labels if got[i]["held_out"]]
    assert 300 < len(held) < 450
    assert np.mean([p == t for p, t in held]) > 0.97
    assert all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.3) for x in got.values())
    # labels of held out rows are never learnt from
    flipped = [(i, q, 1 - t if got[i]["held_out"] else t) for i, q, t in labels]
    again = toxicity.classify(docs, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")).collect()
    assert {x["doc_id"]: x["score"] for x in again} == pytest.approx({i: x["score"] for i, x in got.items()}, abs=1e-9)


def test_toxicity_without_both_classes_scores_zero(spark, labelled):
    docs, labels = labelled
    one = spark.createDataFrame([(i, q, 0) for i, q, _ in labels], "doc_id long, quality int, toxic int")
    assert {x["score"] for x in toxicity.classify(docs, one).collect()} == {0.0}


def test_long_texts_are_hashed_whole():
    text = b"ab c" * 700_000
    pieces = [b for b in toxicity.buckets_of(text, sizes=(4,))]
    assert len(pieces) > 2
    assert sum(map(len, pieces)) == len(b" " + b" ".join(text.split()) + b" ") - 3


def test_raking_meets_the_targets(spark):
    r = random.Random(2)
    cells = [(f"s{a}", f"l{b}", f"t{c}", r.randint(1, 10_000)) for a in range(6) for b in range(3) for c in range(2)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    marginals = (mixing.Marginal("source", 0.5), mixing.Marginal("lang", shares={"l0": 0.6}), mixing.Marginal("topic", 0.0))
    got = mixing.rake(df, marginals).toPandas()
    w = np.zeros((6, 3, 2))
    for s, lang, t, n in cells:
        w[int(s[1]), int(lang[1]), int(t[1])] = n
    tokens = w.copy()
    part = tokens.sum(axis=(1, 2)) ** 0.5
    rest = tokens.sum(axis=(0, 2))[1:]
    goals = [part / part.sum(), np.concatenate(([0.6], 0.4 * rest / rest.sum())), np.array([0.5, 0.5])]
    for _ in range(200):
        for axis, goal in enumerate(goals):
            others = tuple(i for i in range(3) if i != axis)
            shape = [1, 1, 1]
            shape[axis] = -1
            w = w * (goal / w.sum(axis=others)).reshape(shape)
    for x in got.itertuples():
        assert x.weight == pytest.approx(w[int(x.source[1]), int(x.lang[1]), int(x.topic[1])], rel=1e-6)


def test_sample_follows_the_rates(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('w ', repeat('x ', int(id % 7))) as text",
                                        "concat('s', id % 3) as source", "if(id % 5 = 0, 'fr', 'en') as lang")
    plan = mixing.sample_plan(docs).toPandas()
    for _, cell in plan.groupby(["source", "lang", "topic"]):
        rate = cell.rate.iloc[0]
        p = rate - np.floor(rate)
        assert set(cell.copies) <= {np.floor(rate), np.floor(rate) + 1}
        assert abs((cell.copies - np.floor(rate)).mean() - p) < 5 * np.sqrt(p * (1 - p) / len(cell)) + 1e-9
    assert plan.kept.mean() > 0.8 and (plan.kept == (plan.copies > 0)).all()
    taken = mixing.sample(docs).toPandas()
    assert list(taken.columns) == [*docs.columns, "copies"]
    assert dict(zip(taken.doc_id, taken.copies)) == dict(zip(plan.doc_id[plan.kept], plan.copies[plan.kept]))


def test_a_tiny_cell_is_repeated_and_shrinks_no_other(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('w', repeat(' x', 9)) as text", "concat('s', id % 4) as source", "'en' as lang")
    before = mixing.sample_plan(docs).toPandas()
    docs = docs.unionByName(spark.createDataFrame([(9999, "one two three", "rare", "en")], docs.schema))
    plan = mixing.sample_plan(docs).toPandas()
    total, goal = plan.tokens.sum(), plan.groupby("source").tokens.sum() ** 0.7
    assert (plan.rate * plan.tokens).groupby(plan.source).sum().to_numpy() == pytest.approx((goal / goal.sum() * total).to_numpy(), rel=1e-6)
    assert plan.kept[plan.source != "rare"].mean() > 0.95 * before.kept.mean() and before.kept.mean() > 0.95
    assert plan.copies[plan.source == "rare"].min() > 1
    assert sorted(x["doc_id"] for x in mixing.repeated(docs).select("doc_id").collect()) == sorted(np.repeat(plan.doc_id, plan.copies))
    half = mixing.sample_plan(docs, budget=int(total) // 2).toPandas()
    assert (half.rate * half.tokens).sum() == pytest.approx(int(total) // 2, rel=1e-6)


def test_the_topic_may_be_a_column(spark):
    docs = spark.createDataFrame([(i, "a b c", "s", "en", ["x", "y", None][i % 3], 5) for i in range(90)],
                                 "doc_id long, text string, source string, lang string, subject string, copies int")
    plan = mixing.sample_plan(docs, topic="subject").toPandas()
    assert dict(plan.topic.value_counts(dropna=False)) == {"x": 30, "y": 30, None: 30}
    taken = mixing.sample(docs, topic="subject")
    assert taken.columns == docs.columns and {r["copies"] for r in taken.collect()} <= {1, 2}
