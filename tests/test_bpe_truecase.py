"""BPE learning/encoding against brute force; truecasing on a small fixture."""

from collections import Counter

from tessera.operators import bpe, truecase

LINES = ["the lower newest widest", "low lower lowest newer", "the new wider", "", "low low low the"]


def brute_learn(lines, k):
    vocab = Counter(w for l in lines for w in l.split())
    segs = {w: list(w[:-1]) + [w[-1] + "</w>"] for w in vocab}
    merges = []
    for _ in range(k):
        pairs = Counter()
        for w, n in vocab.items():
            s = segs[w]
            for a, b in zip(s, s[1:]):
                pairs[(a, b)] += n
        if not pairs:
            break
        (a, b), cnt = sorted(pairs.items(), key=lambda kv: (-kv[1], kv[0]))[0]
        merges.append((a, b, cnt))
        for w in segs:
            s, out, i = segs[w], [], 0
            while i < len(s):
                if i < len(s) - 1 and (s[i], s[i + 1]) == (a, b):
                    out.append(a + b)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            segs[w] = out
    return merges


def _lines(spark):
    return spark.createDataFrame([(0, i, t) for i, t in enumerate(LINES)], "doc_id long, line_no long, text string")


def test_learn_merges_matches_brute_force(spark):
    got = [(r.left, r.right, r.cnt) for r in bpe.learn_merges(_lines(spark), 8, checkpoint_every=3)
           .orderBy("rank").collect()]
    assert got == brute_learn(LINES, 8)


def test_encode_decode(spark):
    merges = bpe.learn_merges(_lines(spark), 8)
    ranks = {(r.left, r.right): r.rank for r in merges.collect()}
    enc = {r.line_no: r.text for r in bpe.encode_corpus(_lines(spark), merges).collect()}
    for i, line in enumerate(LINES):
        expect = " ".join("@@ ".join(bpe.segment_word(w, ranks)) for w in line.split())
        assert enc[i] == expect
        assert enc[i].replace("@@ ", "") == line


def test_truecase(spark):
    lines = spark.createDataFrame([(0, 0, "The paris trip. The Paris museum and Paris"),
                                   (0, 1, "paris is big. Big city"), (0, 2, "")],
                                  "doc_id long, line_no long, text string")
    toks = truecase.token_table(lines)
    model = {r.lc: r.best for r in truecase.case_model(toks).collect()}
    assert model["paris"] == "Paris"              # 2× Paris vs 1× paris among non-initial tokens
    out = {r.line_no: r.text for r in truecase.truecase(toks, truecase.case_model(toks)).collect()}
    # "The" never occurs mid-sentence, so it has no model entry and stays;
    # mid-sentence "paris" is a known form and stays; initial "paris" → best.
    assert out[0] == "The paris trip. The Paris museum and Paris"
    assert out[1] == "Paris is big. Big city"
    assert out[2] == ""
