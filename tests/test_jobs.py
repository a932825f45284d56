"""End-to-end translate-folder job and the processor chains."""

import glob
import json
import os
import tempfile

from pyspark.sql import functions as F

from tessera.functions import processors as P
from tessera.operators.translate import translate_folder


def test_translate_folder_layout_and_resume(spark):
    d = tempfile.mkdtemp(prefix="tessera-in-")
    os.makedirs(f"{d}/sub")
    words = " ".join(f"w{i}" for i in range(450))
    with open(f"{d}/a.txt", "w") as f:
        f.write(f"hello mail me at x.y@z.org\n\n{words}\n")
    with open(f"{d}/sub/b.txt", "w") as f:
        f.write("one\r line")
    out_dir = tempfile.mkdtemp(prefix="tessera-out-")

    def factory():
        return lambda texts: [[t, t.upper()] for t in texts]
    out = translate_folder(spark, d, out_dir, decoder_factory=factory, n_best=2, fmt="json", extract_tags=True)
    files = sorted(glob.glob(f"{out}/doc=*/part-*"))
    rows = {}
    for f in files:
        doc = os.path.basename(os.path.dirname(f))
        for line in open(f):
            rows.setdefault(doc, []).append(json.loads(line))
    a = rows["doc=a.txt"]
    assert [(r["id"]) for r in a] == [0, 0, 1, 1, 2, 2]              # ids dense, n-best rows share the id
    assert a[0]["translation"] == "hello mail me at  x.y@z.org"      # placeholder went through and came back
    assert a[1]["translation"].startswith("HELLO") and a[1]["translation"].endswith("x.y@z.org")
    assert a[2]["translation"] == "" and a[4]["translation"] == words
    assert len(rows) == 2
    # resume: with the same arguments the finished stage is read, not made again
    stages = f"{out_dir}/_stages"
    made = os.listdir(stages)
    again = translate_folder(spark, d, out_dir, decoder_factory=factory, n_best=2, fmt="marian", extract_tags=True)
    assert os.listdir(stages) == made
    first = open(sorted(glob.glob(f"{again}/doc=a.txt/part-*"))[0]).readline().strip()
    assert first.startswith("0 ||| hello")
    # a stage without its marker is written again; other arguments get a stage of their own
    os.remove(f"{stages}/{made[0]}/_SUCCESS")
    translate_folder(spark, d, out_dir, decoder_factory=factory, n_best=2, extract_tags=True)
    assert os.path.exists(f"{stages}/{made[0]}/_SUCCESS")
    one = translate_folder(spark, d, out_dir, decoder_factory=factory, n_best=1, extract_tags=True)
    assert len(os.listdir(stages)) == 2
    assert sum(1 for f in glob.glob(f"{one}/doc=a.txt/part-*") for _ in open(f)) == 3


def test_processor_chains(spark):
    df = spark.createDataFrame([("He said: “well-known” (test), 3.14!",)], "t string")
    tok = df.select(P.tokenize(F.col("t")).alias("t")).first().t
    assert tok == 'He said : “ well @-@ known ” ( test ) , 3.14 !'
    back = df.select(P.detokenize(P.normalize_punct(P.tokenize(F.col("t")))).alias("t")).first().t
    assert back.startswith("He said:") and "well-known" in back
    proc = P.get_processor("MultilingualSpmTextProcessor", "kk", "en")
    assert df.select(proc.pre_piece(F.lit("x")).alias("p")).first().p == "▁ <2en> x"
    assert set(P.PROCESSORS) >= {"MosesSubwordNmtTextProcessor", "QuerySpmTextProcessor"}


def test_chains_truecase_and_segment(spark):
    """Every chain's encoded text against the steps in plain Python; the default chain comes back whole."""
    from tessera.operators import bpe, truecase
    from tessera.operators.translate import translate_lines
    raw = [(0, 0, "The dog runs, the Dog sleeps."), (0, 1, ""), (0, 2, "Lower lowest low the dog ||| low"), (1, 0, "the cat saw Ann; Ann ran")]
    lines = spark.createDataFrame(raw, "doc_id long, line_no long, text string")
    tokenized = lines.withColumn("text", P.tokenize(F.col("text")))
    cases = truecase.case_model(truecase.token_table(tokenized)).cache()
    merges = bpe.learn_merges(tokenized, 12).cache()
    models = P.Models(cases, merges)
    ranks = {(m.left, m.right): m.rank for m in merges.collect()}
    best = {c.lc: (c.best, set(c.forms)) for c in cases.collect()}

    def cased(text):
        out, first = [], True
        for t in text.split():
            known = best.get(t.lower())
            out.append(t if known is None or (not first and t in known[1]) else known[0])
            first = t[-1] in ".!?:"
        return " ".join(out)

    def spelled(text, style):
        words = [bpe.segment_word(w, ranks) for w in text.split()]
        return " ".join("\u2581" + " ".join(w) for w in words) if style == "spm" else " ".join("@@ ".join(w) for w in words)

    for name in P.PROCESSORS:
        proc = P.get_processor(name, "en", "en")
        got = {(r.doc_id, r.line_no): r.text for r in P.encode_lines(lines, proc, models).collect()}
        pre = {(r.doc_id, r.line_no): r.t for r in lines.select("doc_id", "line_no", proc.pre(F.trim("text")).alias("t")).collect()}
        for key, text in pre.items():
            text = cased(text.strip()) if proc.truecases else text.strip()
            assert got[key] == (spelled(text, proc.subwords) if proc.subwords else text), (name, key)
    default = P.get_processor("MosesSubwordNmtTextProcessor", "en", "en")
    back = translate_lines(lines, ("doc_id", "line_no"), default, models=models).orderBy("doc_id", "line_no").collect()
    assert [r.translation for r in back][:2] == ["The dog runs, the Dog sleeps.", ""]
    import pytest
    with pytest.raises(ValueError):
        translate_lines(lines, ("doc_id", "line_no"), default)
