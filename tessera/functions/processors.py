"""Text processors: the pre/post hooks of a translation job.

A processor is three Column → Column functions, ``pre`` (whole line, before
wrapping), ``pre_piece`` (each piece, after wrapping) and ``post`` (the
re-joined translation), and the corpus steps between ``pre`` and wrapping that
need a model: ``truecases`` (a case model, ``operators.truecase``) and
``subwords``: "bpe" (merges, ``operators.bpe``) or "spm" (pieces with word-start
marks, ``operators.unigram``; without pieces, merges in that spelling).  The models
come as ``Models``; ``encode_lines`` runs the encode side of a chain.

The tokeniser, detokeniser and punctuation normaliser (F36, F37, F40) are
documented rule subsets, not byte-compatible re-implementations of the
external scripts the reference calls.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T

ColFn = Callable[[Column], Column]


def _id(c: Column) -> Column:
    return c


def chain(*fns: ColFn) -> ColFn:
    def run(c: Column) -> Column:
        for f in fns:
            c = f(c)
        return c
    return run


@dataclass(frozen=True)
class TextProcessor:
    """The processor interface; the base is a no-op on every hook."""
    name: str = "TextProcessor"
    pre: ColFn = _id
    pre_piece: ColFn = _id
    post: ColFn = _id
    truecases: bool = False
    subwords: str | None = None


@dataclass(frozen=True)
class Models:
    """What the corpus steps of a chain need: ``cases`` as made by
    ``truecase.case_model``, ``merges`` as made by ``bpe.learn_merges`` with an
    optional vocabulary (S12) whose units must occur ``threshold`` times, and
    ``pieces`` as made by ``unigram.learn``."""
    cases: DataFrame | None = None
    merges: DataFrame | None = None
    vocab: DataFrame | None = None
    threshold: int = 1
    pieces: DataFrame | None = None


def encode_lines(lines: DataFrame, proc: TextProcessor, models: Models | None = None, keys=("doc_id", "line_no"),
                 text: str = "text", keep=()) -> DataFrame:
    """The encode side of a chain up to wrapping: ``keys…, keep…, text``."""
    from tessera.operators import bpe, truecase, unigram
    ids = [*keys, *keep]
    models = models or Models()
    out = lines.select(*ids, T.strip(proc.pre(T.strip(F.col(text)))).alias(text))
    if proc.truecases:
        if models.cases is None:
            raise ValueError(f"{proc.name} needs a case model")
        out = truecase.truecase_lines(out, models.cases, ids, text).withColumnRenamed("text", text)
    if proc.subwords == "spm" and models.pieces is not None:
        out = unigram.encode(out, models.pieces, ids, text)
    elif proc.subwords:
        if models.merges is None:
            raise ValueError(f"{proc.name} needs merges")
        out = bpe.encode_corpus(out, models.merges, ids, text, proc.subwords, models.vocab, models.threshold)
    return out


# --- documented rule subsets of the external tools ---------------------------
# quote/dash characters folded by the punctuation normaliser.
PUNCT_FOLD_FROM = "“”„«»‘’‚´`–—"
PUNCT_FOLD_TO = "\"\"\"\"\"''''''--"


def normalize_punct(c: Column) -> Column:
    """F40 (subset): fold typographic quotes and dashes, space after , and ;
    collapse whitespace."""
    c = F.translate(c, PUNCT_FOLD_FROM, PUNCT_FOLD_TO)
    c = F.regexp_replace(c, r"([,;])(?=\S)", "$1 ")
    return T.collapse_ws(c)


def tokenize(c: Column) -> Column:
    """F36 (subset): split punctuation off words, aggressive hyphen split
    (``a-b`` → ``a @-@ b``); periods and commas inside numbers stay."""
    c = F.regexp_replace(c, r"(?U)(\w)-(?=\w)", "$1 @-@ ")
    c = F.regexp_replace(c, r"(?U)([^\w\s'@.,-])", " $1 ")
    c = F.regexp_replace(c, r"(?U)([.,])(?!\d)", " $1 ")
    return T.collapse_ws(c)


def detokenize(c: Column) -> Column:
    """F37 (subset, English rules): inverse of :func:`tokenize`."""
    c = F.regexp_replace(c, r" @-@ ", "-")
    c = F.regexp_replace(c, r" ([.,!?;:%)\]}])", "$1")
    c = F.regexp_replace(c, r"([(\[{$]) ", "$1")
    return T.collapse_ws(c)


def remove_punct(c: Column) -> Column:
    """token-wise punctuation removal, then punctuation normalisation."""
    from tessera.functions.normalize import remove_punct_tokens
    return normalize_punct(remove_punct_tokens(c))


#: Languages that the normalisation step knows; all others pass through unchanged.
NORMALIZED = ("en", "sw", "tl", "so", "lt", "bg", "ps", "kk", "ka")


def norm_for(language: str | None, romanized: bool = True, foreign: bool = True) -> ColFn:
    """the language's normalisation (:func:`normalize_column`); text of a
    language without rules is left as it is."""
    from tessera.functions.normalize import normalize_column
    if language not in NORMALIZED:
        return _id
    return lambda c: normalize_column(c, language, romanized, foreign)


# --- composite chains (C1-C9) -------------------------------------------------
def multilingual_spm(src: str, tgt: str) -> TextProcessor:            # C1
    return TextProcessor("MultilingualSpmTextProcessor", subwords="spm",
                         pre_piece=lambda p: F.concat(F.lit(f"▁ <2{tgt}> "), p), post=T.spm_decode)


def spm_multilingual(src: str, tgt: str) -> TextProcessor:            # C2
    return TextProcessor("SpmMultilingualTextProcessor", subwords="spm",
                         pre_piece=lambda p: T.language_tag(p, F.lit(tgt)), post=T.spm_decode)


def moses(src: str, tgt: str) -> TextProcessor:                       # C3
    return TextProcessor("MosesTextProcessor", pre=tokenize, truecases=True, post=chain(T.detruecase, detokenize))


def moses_subword(src: str, tgt: str) -> TextProcessor:               # C4 (default)
    return TextProcessor("MosesSubwordNmtTextProcessor", pre=tokenize, truecases=True, subwords="bpe",
                         post=chain(T.bpe_decode, T.detruecase, detokenize))


def norm_subword(src: str, tgt: str) -> TextProcessor:                # C5
    return TextProcessor("NormSubwordNmtTextProcessor", pre=norm_for(src), subwords="bpe",
                         post=chain(T.bpe_decode, norm_for(tgt)))


def query_moses_subword(src: str, tgt: str) -> TextProcessor:         # C6
    return TextProcessor("QueryMosesSubwordNmtTextProcessor", pre=chain(T.append_query, tokenize), truecases=True, subwords="bpe",
                         post=chain(T.bpe_decode, T.detruecase, detokenize))


def remove_punct_moses_subword(src: str, tgt: str) -> TextProcessor:  # C7
    return TextProcessor("RemovePunctMosesSubwordNmtTextProcessor", pre=chain(remove_punct, tokenize), truecases=True, subwords="bpe",
                         post=chain(T.bpe_decode, T.detruecase, detokenize))


def normpunct_moses_subword(src: str, tgt: str) -> TextProcessor:     # C8
    return TextProcessor("MosesNormPunctMosesSubwordNmtTextProcessor", pre=chain(normalize_punct, tokenize), truecases=True, subwords="bpe",
                         post=chain(T.bpe_decode, T.detruecase, detokenize))


def query_spm(src: str, tgt: str) -> TextProcessor:                   # C9
    return TextProcessor("QuerySpmTextProcessor", pre=T.append_query, subwords="spm", post=T.spm_decode)


def spm(src: str, tgt: str) -> TextProcessor:
    return TextProcessor("SpmTextProcessor", subwords="spm", post=T.spm_decode)


def base(src: str, tgt: str) -> TextProcessor:
    return TextProcessor()


# Registry by class name (the names the routing table C10 returns).
PROCESSORS: dict[str, Callable[[str, str], TextProcessor]] = {
    "TextProcessor": base,
    "MultilingualSpmTextProcessor": multilingual_spm,
    "SpmMultilingualTextProcessor": spm_multilingual,
    "MosesTextProcessor": moses,
    "MosesSubwordNmtTextProcessor": moses_subword,
    "NormSubwordNmtTextProcessor": norm_subword,
    "QueryMosesSubwordNmtTextProcessor": query_moses_subword,
    "RemovePunctMosesSubwordNmtTextProcessor": remove_punct_moses_subword,
    "MosesNormPunctMosesSubwordNmtTextProcessor": normpunct_moses_subword,
    "QuerySpmTextProcessor": query_spm,
    "SpmTextProcessor": spm,
}


def get_processor(name: str, src: str, tgt: str) -> TextProcessor:
    return PROCESSORS[name](src, tgt)
