"""Alignment against decoded bytes alone, on whole texts encoded in one go."""

import hashlib
import os
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import token_align
from tessera.llm.common import table
from tessera.llm.queries import QUERIES
from tests.llm.helpers import edge_documents

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "a", " a", "  a b", "a ", "a  ", "a\n b", "\nabc def", "x <s> </s> <|endoftext|> y", "héllo 漢字\U0001d11e  b", "▁x a", "a ▁ b",
       "a\x85 b", "a \x85b c", "tab\t x\t", "  ", " \n ", "a\x00b c", "é x", "　a 　b c", "don't  we'll\n\n\n  x", "\U0001f937\U0001f3fd‍♂ ok",
       "a᠎ b ᠎c d", "0123 <0x41> é" * 3, "﻿a b", "x" * 300 + " " + "漢" * 90]


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        code = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
        self.a_token = {i: bytes(code.get(c, 0) for c in t) for t, i in self.a.get_vocab().items()}

    def b_token(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        """List of (A ids, B ids), or none without tokens."""
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        left, right = [self.a_token[i] for i in a], [self.b_token(i) for i in b]
        if not b"".join(left) == b"".join(right) == (" " + text).encode():
            return []
        ends = [set(), set()]
        for k, tokens in enumerate((left, right)):
            at = 0
            for t in tokens:
                at += len(t)
                ends[k].add(at)
        out, common = [], ends[0] & ends[1]
        parts = []
        for ids, tokens in ((a, left), (b, right)):
            at, own, done = 0, [], []
            for i, t in zip(ids, tokens):
                at += len(t)
                own.append(i)
                if at in common:
                    done.append(own)
                    own = []
            parts.append(done)
        out.extend(zip(*parts))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def brute(plain, docs):
    found = [(d, plain.groups(t)) for d, t in docs]
    counts = Counter((a[-1], b[-1]) for _, g in found for a, b in g)
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    rows = []
    for d, g in found:
        links = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        rows.append((d, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links), sum(counts[x] == top[x[1]] for x in links),
                     sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(rows, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_query_equals_brute_force(spark, plain):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op13_token_align"](spark, SF)) == brute(plain, docs)


@pytest.mark.parametrize("limit", [token_align.BROADCAST_PAIRS, 0])
def test_odd_texts(spark, plain, limit):
    r = random.Random(5)
    texts = ODD + ["".join(r.choice(" \n\t ab'sé漢\U0001d11e▁<>0　.,-  ") for _ in range(r.randint(0, 40))) for _ in range(600)]
    docs = list(enumerate(texts))
    assert rows_of(token_align.align(spark.createDataFrame(docs, "doc_id long, text string"), A, B, limit=limit)) == brute(plain, docs)


def test_spans_are_the_refined_ones(plain):
    own = token_align.aligner(A, B)
    for text in [t for t in ODD if plain.groups(t)] + ["漢\U0001d11e\U0001f937 á̂ ß"]:
        for (ids, ends), lengths in ((own.ends_a(" " + text), own.a_len), (own.ends_b(" " + text), own.b_len)):
            assert ends.tolist() == lengths[ids].cumsum().tolist(), text  # spans alone, before decoded bytes decide


def test_edge_documents(spark, plain):
    docs = edge_documents(spark)
    assert rows_of(token_align.align(docs, A, B)) == brute(plain, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert token_align.align(docs.limit(0), A, B).collect() == []


def test_spans_of_documents(spark, plain):
    docs = spark.createDataFrame([(1, "naïve 漢 x"), (2, None), (3, "▁ y")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in token_align.spans(docs, A, B).collect()}
    assert got[2]["cuts"] == got[3]["a_ids"] == []
    assert got[1]["cuts"][-1] == len(" naïve 漢 x".encode()) == got[1]["a_ends"][-1] == got[1]["b_ends"][-1]
    assert len(got[1]["cuts"]) == len(plain.groups("naïve 漢 x"))
