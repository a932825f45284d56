"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import pytest

import corpus_pipeline
from tessera.llm import decontaminate, exact_dedup, html_extract, mixing, secrets, simhash, suffix_dedup, toxicity, url_filter, warc
from tests.llm.helpers import edge_documents, edge_pages, prose

PAGE_RULES = [("com", "/", "allow"), (None, "/x", "block"), ("b.net", "/fr/", "block"), ("b.net", "/fr/", "allow")]


def labels(spark):
    return spark.createDataFrame([(4, 1, 1), (5, 1, 0), (5, 1, 1), (None, 1, 1), (7, 0, None), (9, 1, 0), (8, 1, 1)],
                                 "doc_id long, quality int, toxic int")


def benchmark(spark):
    return spark.createDataFrame([(1, prose(4, 50)), (2, None), (3, ""), (4, "one"), (4, "one"), (None, prose(77, 20))], "item_id long, text string")


def rules(spark):
    return spark.createDataFrame(PAGE_RULES, "host string, path string, action string")


BY_DOCUMENT = {
    "simhash": lambda s, d: simhash.near_groups(d),
    "exact": lambda s, d: exact_dedup.mark_copies(d),
    "secrets": lambda s, d: secrets.find_secrets(d),
    "toxicity": lambda s, d: toxicity.classify(d, labels(s)),
    "mixing": lambda s, d: mixing.sample_plan(d),
    "suffix": lambda s, d: suffix_dedup.repeated_spans(d),
}
BY_PAGE = {
    "url": lambda s, p: url_filter.judge_urls(p, rules(s)),
    "html": lambda s, p: html_extract.extract(p),
    "warc": lambda s, p: warc.archive_pages(p),
}


@pytest.fixture(scope="module")
def docs(spark):
    return edge_documents(spark).cache()


@pytest.fixture(scope="module")
def pages(spark):
    return edge_pages(spark).cache()


@pytest.mark.parametrize("name", BY_DOCUMENT)
def test_every_document_has_its_row(spark, docs, name):
    found = [r["doc_id"] for r in BY_DOCUMENT[name](spark, docs).collect()]
    assert sorted(found, key=repr) == sorted((r["doc_id"] for r in docs.collect()), key=repr)


@pytest.mark.parametrize("name", BY_PAGE)
def test_every_page_has_its_row(spark, pages, name):
    found = [r["page_id"] for r in BY_PAGE[name](spark, pages).collect()]
    assert sorted(found, key=repr) == sorted((r["page_id"] for r in pages.collect()), key=repr)


@pytest.mark.parametrize("name", [*BY_DOCUMENT, *BY_PAGE])
def test_empty_table(spark, docs, pages, name):
    if name in BY_DOCUMENT:
        assert BY_DOCUMENT[name](spark, docs.limit(0)).collect() == []
    else:
        assert BY_PAGE[name](spark, pages.limit(0)).collect() == []


def test_leaks_of_edge_tables(spark, docs):
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark(spark)).collect()}
    assert found == {(4, 1), (5, 1), (9, 1), (7, 4)}
    assert decontaminate.leaks(docs.limit(0), benchmark(spark)).collect() == []
    assert decontaminate.leaks(docs, benchmark(spark).limit(0)).collect() == []


def test_verdicts_of_edge_pages(spark, pages):
    got = {r["page_id"]: tuple(r)[1:] for r in BY_PAGE["url"](spark, pages).collect()}
    assert got == {1: ("a.com", "/x", "com/", "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"),
                   None: ("a.com:80", "", None, "allow"), 5: ("b.net", "/fr/1\n2", "b.net/fr/", "block")}


def test_texts_of_edge_pages(spark, pages):
    got = {r["page_id"]: r["text"] for r in BY_PAGE["html"](spark, pages).collect()}
    assert got[1] == got[2] == "T\nsome text" and got[3] == got[4] == "" and got[5] == "text & bold"
    assert got[None] == prose(1, 60_000)


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages_take_edge_tables(spark, docs, empty, tmp_path):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    table = docs.limit(0) if empty else docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, str(tmp_path))
        assert out.columns == [*docs.columns, *(["copies"] if name == "mixing" else [])], name
        assert out.count() <= table.count()
        out.collect()
