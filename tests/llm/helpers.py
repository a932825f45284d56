"""Small tables with the awkward cases that every operator must take."""

import random

#: Names that operators use inside; tables carry them as extra columns.
CLASHES = ("digest", "fp", "key", "doc", "tokens", "score", "kept", "gone", "heavy", "winner", "n", "row", "keep", "size", "topic",
           "probability", "weight", "rate", "t", "words", "host", "path", "rule", "verdict", "runs", "vote", "top", "sha1", "first", "mark")
WORDS = [a + b + c for a in "bcdfghklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l", "")]
LONG = 60_000


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edge_documents(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t ", None, "a"), (4, prose(4, 50), "en", None), (5, prose(4, 50), "fr", "b"),
            (5, prose(4, 50), "fr", "b"), (6, prose(6, LONG), "en", "a"), (7, "one", "en", "b"), (8, "é" * 500, "de", "b"),
            (None, "no id " + prose(9, 30), "en", "b"), (None, None, None, None), (9, prose(9, 120) + " " + prose(4, 50), "en", "a")]
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, len(r[1] or ""), *("clash",) * len(CLASHES)) for r in rows],
                                 f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


def edge_pages(spark):
    body = "<html><body><article><h1>T</h1><p>some text</p></article></body></html>"
    rows = [(1, "http://a.com/x", body), (2, None, body), (3, "no scheme", None), (3, "no scheme", None), (4, "http://", ""),
            (None, "http://A.com:80?q", "<p>" + prose(1, LONG)), (5, "ftp://b.net/fr/1\n2", "text & <b>bold")]
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *("clash",) * len(CLASHES)) for r in rows], f"page_id long, url string, html string, {extra}")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
