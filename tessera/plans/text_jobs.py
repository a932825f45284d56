"""Text-function queries (F3-F33, A12) over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import normalize as N
from tessera.functions import text as T
from tessera.operators import external
from tessera.operators import placeholders as PH
from tessera.plans.corpus import lines_of
from tessera.plans.registry import register
from tessera.plans.sqlparts import LINES, with_
from tessera.sources.tables import read_table

# RE2 (DuckDB) spellings of the placeholder patterns.  RE2 has no
# look-arounds, so the e-mail pattern consumes its boundary characters and is
# applied through marker characters (equal results unless two addresses are
# separated by exactly one character).
_TAG_RE2 = PH.TAG_PATTERN
_URL_RE2 = r"(?i)\b(?:(?:[\w-]+://?|www[.])[^\s()<>]+(?:\([\w\d]+\)|(?:[^[:punct:]\s]|/)))"
_EML_BODY = (r"[a-z0-9!#$%&'*+/=?^_‘{|}~-]+(?:\.[a-z0-9!#$%&'*+/=?^_‘{|}~-]+)*"
             r"@(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+[a-z0-9](?:[a-z0-9-]*[a-z0-9])?")
_HANDLE_RE2 = PH.HANDLE_PATTERN


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _duck_kind(prev: str, cur: str, kind: str, pattern: str | None) -> str:
    """CTEs that apply one placeholder kind in DuckDB (split + re-interleave)."""
    if pattern is None:   # e-mail: mark matches first, then split on the marks
        mark = (f"regexp_replace(t, {_q('(^|[^\\w])(' + _EML_BODY + ')([^\\w]|$)')}, "
                f"'\\1' || chr(1) || '\\2' || chr(2) || '\\3', 'g')")
        split_re, hit_re, grp = r"\x01[^\x02]*\x02", r"\x01([^\x02]*)\x02", 1
        src = f"{cur}_m AS (SELECT *, {mark} AS _mk FROM {prev}),\n"
        base, col = f"{cur}_m", "_mk"
    else:
        split_re, hit_re, grp = pattern, pattern, 0
        src, base, col = "", prev, "t"
    return (src + f"{cur}_s AS (SELECT *, regexp_split_to_array({col}, {_q(split_re)}) AS _parts, "
            f"regexp_extract_all({col}, {_q(hit_re)}, {grp}) AS _hits FROM {base}),\n"
            f"{cur} AS (SELECT * EXCLUDE (t, tags, _parts, _hits{', _mk' if pattern is None else ''}), "
            f"CASE WHEN len(_hits) > 0 THEN array_to_string(list_transform(_parts, lambda p, i: "
            f"CASE WHEN i = 1 THEN p ELSE ' [{kind}' || CAST(i - 2 AS VARCHAR) || '] ' || p END), '') ELSE t END AS t, "
            f"list_concat(tags, list_transform(_hits, lambda h, i: {{'placeholder': '[{kind}' || CAST(i - 1 AS VARCHAR) || ']', "
            f"'original': h}})) AS tags FROM {cur}_s)")


def duck_placeholders(src: str) -> str:
    """CTE chain ``ph0 … ph4`` over ``src`` (which has column ``t``)."""
    return (f"ph0 AS (SELECT *, []::STRUCT(placeholder VARCHAR, original VARCHAR)[] AS tags FROM {src}),\n"
            + _duck_kind("ph0", "ph1", "TAG", _TAG_RE2) + ",\n"
            + _duck_kind("ph1", "ph2", "URL", _URL_RE2) + ",\n"
            + _duck_kind("ph2", "ph3", "EML", None) + ",\n"
            + _duck_kind("ph3", "ph4", "HANDLE", _HANDLE_RE2))


def _count_kind(tags, kind: str):
    return F.size(F.filter(tags, lambda t: t["placeholder"].startswith(f"[{kind}"))).cast("int")


@register("repair_chars", r"""
SELECT doc_id, translate(text, chr(13) || chr(8204) || chr(65279), '') AS text,
       CAST(length(text) - length(translate(text, chr(13) || chr(8204) || chr(65279), '')) AS INTEGER) AS n_removed
FROM documents
""")
def repair_chars(spark, sf_dir):
    """drop CR, NUL, ZWNJ and BOM from whole documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    fixed = T.repair_chars(F.col("text"))
    return docs.select("doc_id", fixed.alias("text"), (F.length("text") - F.length(fixed)).cast("int").alias("n_removed"))


@register("extract_placeholders_html", "WITH src AS (SELECT page_id, url || ' ' || html AS t FROM pages),\n"
          + duck_placeholders("src") + r"""
SELECT page_id, t AS text,
       CAST(len(list_filter(tags, lambda x: starts_with(x.placeholder, '[TAG'))) AS INTEGER) AS n_tag,
       CAST(len(list_filter(tags, lambda x: starts_with(x.placeholder, '[URL'))) AS INTEGER) AS n_url,
       CAST(len(list_filter(tags, lambda x: starts_with(x.placeholder, '[EML'))) AS INTEGER) AS n_eml,
       CAST(len(list_filter(tags, lambda x: starts_with(x.placeholder, '[HANDLE'))) AS INTEGER) AS n_handle
FROM ph4
""")
def extract_placeholders_html(spark, sf_dir):
    """F30 on raw web pages: markup, then URLs, e-mails and handles."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", F.concat_ws(" ", "url", "html").alias("t"))
    ext = PH.extract_placeholders(pages, "t", "text", "tags")
    tags = F.col("tags")
    return ext.select("page_id", "text", _count_kind(tags, "TAG").alias("n_tag"), _count_kind(tags, "URL").alias("n_url"),
                      _count_kind(tags, "EML").alias("n_eml"), _count_kind(tags, "HANDLE").alias("n_handle"))


@register("extract_reinsert_emails", with_(LINES) + ", src AS (SELECT doc_id, line_no, text AS t FROM lines),\n"
          + duck_placeholders("src") + r"""
SELECT doc_id, line_no, t AS masked, CAST(len(tags) AS INTEGER) AS n_placeholders,
       list_reduce(tags, lambda acc, x: CASE WHEN position(x.placeholder IN acc) > 0
           THEN left(acc, position(x.placeholder IN acc) - 1) || x.original
                || substr(acc, position(x.placeholder IN acc) + length(x.placeholder))
           ELSE acc || ' ' || x.original END, t) AS restored
FROM ph4
""")
def extract_reinsert_emails(spark, sf_dir):
    """F30 → identity decoder → F31 on every document line (J4: tags travel with the line)."""
    lines = lines_of(spark, sf_dir)
    ext = PH.extract_placeholders(lines, "text", "masked", "tags")
    return ext.select("doc_id", "line_no", "masked", F.size("tags").cast("int").alias("n_placeholders"),
                      PH.reinsert_column(F.col("masked"), F.col("tags")).alias("restored"))


@register("normalize_latin", with_(LINES) + r"""
SELECT doc_id, line_no, trim(regexp_replace(strip_accents(lower(text)), '\s+', ' ', 'g')) AS norm
FROM lines
""")
def normalize_latin(spark, sf_dir):
    """English rules, lower-cased, diacritics removed, per line."""
    out = N.normalize_corpus(lines_of(spark, sf_dir), "en", text="text", out="norm", lowercase=True)
    return out.select("doc_id", "line_no", "norm")


@register("remove_punct", with_(LINES) + r"""
, tok AS (SELECT doc_id, line_no, CASE WHEN trim(text) = '' THEN []::VARCHAR[]
                                       ELSE regexp_split_to_array(trim(text), '\s+') END AS toks FROM lines)
SELECT doc_id, line_no, array_to_string(list_filter(list_transform(toks, lambda w:
         CASE WHEN regexp_matches(w, '^%?\p{Nd}+(([.,:\-/\x{066B}])?\p{Nd})*$') THEN w
              WHEN regexp_matches(w, '^''+$') THEN ''
              ELSE regexp_replace(w, '(?:[^\p{L}\p{N}'']|[_”`.,;:?!\[\]{}()|~<>ː*\\/+\-=%$#@^µˆ¹³¼º²Δ⁰¾ⅣⅢⅡ½ㆍφθ])', '', 'g') END),
         lambda w: w <> ''), ' ') AS text
FROM tok
""")
def remove_punct(spark, sf_dir):
    """Token-wise punctuation removal, number tokens kept whole."""
    lines = lines_of(spark, sf_dir)
    return lines.select("doc_id", "line_no", N.remove_punct_tokens(F.col("text")).alias("text"))


@register("cap_repetitions", with_(LINES) + r"""
SELECT doc_id, line_no,
       list_reduce(regexp_extract_all(text, '(?s).'),
                   lambda acc, c: CASE WHEN right(acc, 2) = c || c THEN acc ELSE acc || c END, '') AS text
FROM lines""")
def cap_repetitions(spark, sf_dir):
    """characters repeated 3+ times are cut to 2.  (The oracle has no
    back-references, so it folds over the characters instead.)"""
    lines = lines_of(spark, sf_dir)
    return lines.select("doc_id", "line_no", N.cap_repetitions(F.col("text"), 2).alias("text"))


@register("char_inventory", r"""
SELECT lang, c, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT lang, unnest(regexp_extract_all(text, '(?s).')) AS c FROM documents)
GROUP BY lang, c
""")
def char_inventory(spark, sf_dir):
    """Character counts per language (partial aggregation before the shuffle)."""
    docs = read_table(spark, sf_dir, "documents").select("lang", "text")
    chars = docs.select("lang", F.explode(F.regexp_extract_all("text", F.lit("(?s)."), 0)).alias("c"))
    return chars.groupBy("lang", "c").agg(F.count("*").alias("n"))


@register("language_tag_query_append", with_(LINES) + r"""
, d AS (SELECT l.doc_id, l.line_no, l.text, d.lang, d.source FROM lines l JOIN documents d USING (doc_id))
SELECT doc_id, line_no,
       '<2' || lang || '> ' || trim(trim(text) || ' ||| ' || trim(lang || ' ' || source)) AS text
FROM d
""")
def language_tag_query_append(spark, sf_dir):
    """F28 then F27: ``sentence<TAB>query`` → ``<2xx> sentence ||| query``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    lines = (docs.select("doc_id", "lang", "source",
                         F.posexplode(T.split_lines(T.repair_chars(F.col("text")))).alias("line_no", "text"))
             .withColumn("line_no", F.col("line_no").cast("long")))
    with_query = F.concat_ws("\t", "text", F.concat_ws(" ", "lang", "source"))
    return lines.select("doc_id", "line_no", T.language_tag(T.append_query(with_query), F.col("lang")).alias("text"))


def _bpe_encode(tok_col):
    """Test encoder: split every token into 4-character units joined by ``@@ ``."""
    return F.regexp_replace(tok_col, r"(.{4})(?=.)", "$1@@ ")


@register("bpe_decode_roundtrip", with_(LINES) + r"""
SELECT doc_id, line_no, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM lines
""")
def bpe_decode_roundtrip(spark, sf_dir):
    """F33 on subword-split lines (every line split by a 4-character test segmentation)."""
    lines = lines_of(spark, sf_dir)
    enc = F.array_join(F.transform(T.tokens("text"), _bpe_encode), " ")
    return lines.select("doc_id", "line_no", T.strip(T.bpe_decode(enc)).alias("text"))


@register("spm_decode_roundtrip", with_(LINES) + r"""
SELECT doc_id, line_no, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM lines
""")
def spm_decode_roundtrip(spark, sf_dir):
    """F32 on sentence-piece style lines (``▁`` word starts, 4-character pieces)."""
    lines = lines_of(spark, sf_dir)
    enc = F.array_join(F.transform(T.tokens("text"), lambda w: F.concat(
        F.lit("▁"), F.regexp_replace(w, r"(.{4})(?=.)", "$1 "))), " ")
    return lines.select("doc_id", "line_no", T.spm_decode(enc).alias("text"))


@register("filter_lines", with_(LINES) + """
SELECT doc_id, line_no, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS text FROM lines""")
def filter_lines(spark, sf_dir):
    """Every line through an external program (``tr``, which writes ASCII letters in upper case)."""
    return external.filter_lines(lines_of(spark, sf_dir), ["tr", "a-z", "A-Z"])
