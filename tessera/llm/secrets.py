"""Secret scans: fixed patterns and a randomness test battery.

Three pattern kinds (``assign``, ``access``, ``hex``) are matched as such.  All
other long tokens whose characters are not those of an ordinary word are
candidates: an encoding is inferred from the characters, and three tests ask
whether the token could be a uniformly random string over its alphabet, a
chi-squared test of symbol counts, a runs test above and below the middle of
the alphabet, and a test of the lag-1 serial correlation.  Fisher's method
makes one p-value of the three.

Ordinary words of the corpus are the null hypothesis: the share of words of the
token's length that look at least as random over the same alphabet is the
token's p-value against ordinary text.  Short words often look random, long
ones hardly ever, and with every character the share falls by about the same
factor; so for each encoding the share is fitted to the words of all lengths
(:func:`null_shares`) and falls with the evidence of the whole corpus.  A
Benjamini-Hochberg procedure over the candidates of each encoding, weighted by
length, holds the share of false discoveries below ``ALPHA``.  All counts cover
the whole corpus and are kept as histograms by encoding, length and p-value, a
table of fixed size.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged

# Fixed patterns; on A-Z lower-cased bytes where letters count in either case.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ("assign", "access", "hex", "random")

LEAST = 16  # characters of a candidate
LONGEST = 64  # longer tokens count as this length in the histograms
BINS = 300  # of -log10 p, a tenth each; bin 0 looks most random
ALPHA = 0.01
NULL_WORDS = 1000  # words of one length whose own share holds against the fitted one
STEEPEST = 5.0  # bound of the fitted fall of the log share per character
TOKEN = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
WORD = re.compile(rb"[A-Za-z][a-z]*")

#: Alphabets in the order in which they are tried.
ALPHABETS = (
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("BASE36", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("any", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_="),
)
LETTERS = "abcdefghijklmnopqrstuvwxyz"
OF_HEX = bytes(49 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
OF_TOKEN = bytes(49 if chr(c) in ALPHABETS[-1][1] else 32 for c in range(256))


def encoding_of(token: bytes) -> int:
    """Number of the first alphabet that holds all characters; ``=`` may only pad the end."""
    body = set(token.rstrip(b"=").decode("ascii"))
    return next(i for i, (_, chars) in enumerate(ALPHABETS) if body <= set(chars))


def as_written(word: bytes, encoding: int) -> tuple[bytes, str]:
    """An ordinary word as names in an encoding are written, and the alphabet it
    is tested over: the encoding's, or the letters where it has not all of them.

    Candidates are no plain words: they are of an encoding for their capitals,
    digits and signs.  So the word gets a capital at every fifth place where
    both cases occur, a sign at every tenth and a digit at its end."""
    chars = ALPHABETS[encoding][1]
    if not set(LETTERS) <= set(chars.lower()):
        return word.lower(), LETTERS
    form = bytearray(word.lower() if "a" in chars else word.upper())
    if "a" in chars and "A" in chars:
        form[::5] = bytes(form[::5]).upper()
    sign = next((c for c in "_/" if c in chars), "")
    if sign:
        form[9::10] = sign.encode() * len(form[9::10])
    form[-1:] = b"2"
    return bytes(form), chars


def upper_tail(z: np.ndarray) -> np.ndarray:
    """P(N(0, 1) > z)."""
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z])


def battery(tokens: list[bytes], alphabet: str) -> np.ndarray:
    """Fisher-combined p-values of 'uniformly random over the alphabet', one for each token."""
    size, lens = len(alphabet), np.array([len(t) for t in tokens])
    code = np.zeros(256, np.int64)
    code[np.frombuffer(alphabet.encode(), np.uint8)] = np.arange(size)
    x = code[np.frombuffer(b"".join(tokens), np.uint8)]
    starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    which = np.repeat(np.arange(len(tokens)), lens)
    # symbol counts: chi-squared by its mean and exact variance under uniform draws
    counts = np.bincount(which * size + x, minlength=len(tokens) * size).reshape(-1, size)
    chi2 = (counts ** 2).sum(axis=1) * size / lens - lens
    p_counts = upper_tail((chi2 - (size - 1)) / np.sqrt(2.0 * (size - 1) * (1 - 1 / lens)))
    inner = np.ones(len(x), bool)
    inner[starts] = False  # the first symbol of a token has no predecessor
    before = np.concatenate(([0], x[:-1]))
    # runs above and below the middle: changes are Binomial(n - 1, 2 q (1 - q))
    q = (size // 2) / size
    change = ((x >= size // 2) != (before >= size // 2)) & inner
    rate = 2 * q * (1 - q)
    z = (np.add.reduceat(change, starts) - (lens - 1) * rate) / np.sqrt((lens - 1) * rate * (1 - rate))
    p_runs = np.minimum(1.0, 2 * upper_tail(np.abs(z)))
    # lag-1 serial correlation around the alphabet's mean
    mean, var = (size - 1) / 2, (size ** 2 - 1) / 12
    product = np.where(inner, (x - mean) * (before - mean), 0.0) / var
    z = np.add.reduceat(product, starts) / np.sqrt(lens - 1)
    p_serial = np.minimum(1.0, 2 * upper_tail(np.abs(z)))
    half = -np.log(np.maximum(p_counts, 1e-300) * np.maximum(p_runs, 1e-300) * np.maximum(p_serial, 1e-300) + 1e-300)
    return np.exp(-half) * (1 + half + half ** 2 / 2)  # upper tail of chi-squared with six degrees of freedom


def bins_of(tokens: list[bytes], alphabet: str) -> list[int]:
    if not tokens:
        return []
    return np.minimum(BINS - 1, -10 * np.log10(np.maximum(battery(tokens, alphabet), 1e-300))).astype(int).tolist()


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` in bytes of the fixed patterns, leftmost and not
    overlapping within a kind.  The searches before the patterns only skip
    texts that cannot match."""
    found, low = [], text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(low) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if b"1" * HEX_LEAST in text.translate(OF_HEX):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def long_tokens(text: bytes, spans: list[tuple[int, int, int]]) -> tuple[list, list]:
    """Candidates ``(start, end, token)`` clear of ``spans``, and ordinary words."""
    cands, words = [], []
    if b"1" * LEAST in text.translate(OF_TOKEN):
        for m in TOKEN.finditer(text):
            if WORD.fullmatch(m[0]):
                words.append(m[0])
            elif len(m[0].rstrip(b"=")) >= LEAST and not any(s < m.end() and m.start() < e for s, _, e in spans):
                cands.append((m.start(), m.end(), m[0]))
    return cands, words


def class_of(encoding: int, length: int) -> int:
    return encoding * (LONGEST + 1) + min(length, LONGEST)


def scan(texts: list[bytes]) -> list[tuple]:
    """For each text: base spans, candidates ``(start, end, class, bin)`` (code
    points), and ``class * BINS + bin`` of its long ordinary words in every
    encoding; a class is an encoding and a length."""
    rows, by_encoding, words = [], {}, []
    for i, text in enumerate(texts):
        spans = base_spans(text)
        cands, plain = long_tokens(text, spans)
        if (spans or cands) and not text.isascii():
            points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
        else:
            points = range(len(text) + 1)
        rows.append(([(int(points[s]), k, int(points[e])) for s, k, e in spans], [], []))
        for s, e, token in cands:
            body = token.rstrip(b"=")
            by_encoding.setdefault(encoding_of(token), []).append((i, int(points[s]), int(points[e]), body))
        words += [(i, w) for w in plain]
    for k, found in by_encoding.items():
        for (i, s, e, body), b in zip(found, bins_of([f[3] for f in found], ALPHABETS[k][1])):
            rows[i][1].append((s, e, class_of(k, len(body)), b))
    for k in range(len(ALPHABETS)):
        for chars in (ALPHABETS[k][1], LETTERS):
            forms = [(i, f) for i, (f, over) in ((i, as_written(w, k)) for i, w in words) if over == chars]
            for (i, f), b in zip(forms, bins_of([f for _, f in forms], chars)):
                rows[i][2].append(class_of(k, len(f)) * BINS + b)
    return rows


SCANNED = ("base array<struct<start:long,kind:int,end:long>>, "
           "cands array<struct<start:long,end:long,cls:int,bin:int>>, words array<int>")
SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
CAND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cls", pa.int32()), ("bin", pa.int32())]))


def scanned(docs: DataFrame, key: str, text: str) -> DataFrame:
    id_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = scan([t or b"" for t in batch.column(1).to_pylist()])
            spans = [[dict(zip(("start", "kind", "end"), s)) for s in r[0]] for r in rows]
            cands = [[dict(zip(("start", "end", "cls", "bin"), c)) for c in r[1]] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, SPAN), pa.array(cands, CAND), pa.array([r[2] for r in rows], pa.list_(pa.int32()))],
                names=["doc_id", "base", "cands", "words"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("t")).mapInArrow(run, f"doc_id {id_type}, {SCANNED}")


def null_shares(words: np.ndarray, n: int) -> np.ndarray:
    """For each bin the share of ordinary words of ``n`` characters that look as
    random or more, from ``words[length, bin]`` of one encoding.

    A Poisson regression of those words on all words of their length, whose log
    share is linear in the length and does not rise with it.  The candidate
    counts as one more word of its length that looks as random: with no other,
    the share is one over all words.  Never below the share among the words of
    the length itself, where fewer than ``NULL_WORDS`` count as so many.
    """
    x = (np.arange(len(words)) - n)[:, None]
    size, hits = words.sum(axis=1)[:, None].astype(float), words.cumsum(axis=1).astype(float)
    own = hits[n] / max(size[n, 0], NULL_WORDS)
    size[n] += 1
    hits[n] += 1
    mean = (x * hits).sum(axis=0) / hits.sum(axis=0)
    low, high = np.full(words.shape[1], -STEEPEST), np.zeros(words.shape[1])
    for _ in range(50):  # the mean length of the fitted hits rises with the slope
        slope = (low + high) / 2
        fitted = size * np.exp(x * slope)
        over = (x * fitted).sum(axis=0) / fitted.sum(axis=0) > mean
        low, high = np.where(over, low, slope), np.where(over, slope, high)
    share = hits.sum(axis=0) / (size * np.exp(x * (low + high) / 2)).sum(axis=0)
    return np.maximum.accumulate(np.minimum(1.0, np.maximum(share, own)))


def cuts(cands: dict[tuple[int, int], int], words: dict[tuple[int, int], int], alpha: float = ALPHA) -> dict[int, int]:
    """For each class the largest bin that is a discovery, from histograms ``(class, bin) -> count``.

    p-value: see :func:`null_shares`.  Weighted Benjamini-Hochberg in each
    encoding: a candidate of length ``n`` has weight ``n`` over their mean.
    """
    null = np.zeros((len(ALPHABETS), LONGEST + 1, BINS))
    for (cls, b), c in words.items():
        null[cls // (LONGEST + 1), cls % (LONGEST + 1), b] += c
    out: dict[int, int] = {}
    for k in range(len(ALPHABETS)):
        found = [(cls % (LONGEST + 1), b, c) for (cls, b), c in cands.items() if cls // (LONGEST + 1) == k]
        total = sum(c for _, _, c in found)
        mean = sum(n * c for n, _, c in found) / max(total, 1)
        shares = {n: null_shares(null[k], n) for n in {n for n, _, _ in found}}
        tested = sorted((shares[n][b] * mean / n, n, b, c) for n, b, c in found)
        rank, limit = 0, -1.0
        for i, (q, _, _, c) in enumerate(tested):
            rank += c
            if (i + 1 == len(tested) or tested[i + 1][0] > q) and q <= alpha * rank / total:
                limit = q
        for q, n, b, _ in tested:
            if q <= limit:
                out[class_of(k, n)] = max(out.get(class_of(k, n), -1), b)
    return out


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", alpha: float = ALPHA) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random``.

    ``spans`` lists ``kind:start:end`` (code points, end exclusive) by start,
    then by kind as in ``KINDS``; ``base_sha256`` is the digest of the same list
    without kind ``random``.  A random span never overlaps a base span.  Null
    and empty texts have no span; a corpus without long ordinary words has no
    null and so no discovery.  Repeated rows get equal results; an empty table
    gives an empty one; other columns are not read.
    """
    rows = staged(scanned(docs, key, text), "scanned")
    counted = (rows.select(F.explode("cands").alias("c")).select(F.lit(True).alias("cand"), F.col("c.cls").alias("n"), F.col("c.bin").alias("b"))
                   .unionByName(rows.select(F.explode("words").alias("w")).select(
                       F.lit(False).alias("cand"), F.floor(F.col("w") / BINS).cast("int").alias("n"), F.pmod("w", F.lit(BINS)).cast("int").alias("b")))
                   .groupBy("cand", "n", "b").count().collect())  # at most 2 * classes * BINS rows
    limits = cuts({(r["n"], r["b"]): r["count"] for r in counted if r["cand"]},
                  {(r["n"], r["b"]): r["count"] for r in counted if not r["cand"]}, alpha)
    by_class = F.array(*[F.lit(limits.get(n, -1)) for n in range(class_of(len(ALPHABETS), 0))])
    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans):
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = F.filter("cands", lambda c: c["bin"] <= F.element_at(by_class, c["cls"] + 1))
    random = F.transform(found, lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), c["end"].alias("end")))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                       listed(F.concat("base", random)).alias("spans"), F.size(random).cast("long").alias("n_random"))
