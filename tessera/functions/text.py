"""Column expressions for line-oriented text.

Everything here returns a ``pyspark.sql.Column`` built from native Spark SQL
functions, so it stays inside whole-stage code generation.  Java regexes are
ASCII-only unless they start with ``(?U)``; the reference trims and splits with
Python's Unicode-aware ``str.strip`` / ``str.split``, hence ``(?U)`` below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The characters the repair step deletes (CR, NUL, ZWNJ, BOM).
BROKEN_CHARS = "\r\u0000\u200c\ufeff"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's ``str.isspace`` accepts (derived by rule, not listed).
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: ColumnOrName) -> Column:
    """``str.strip()`` exactly: ``btrim`` with Python's whitespace set (Spark
    ``trim`` only removes U+0020); a plain character-set trim, no regex."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def collapse_ws(c: ColumnOrName) -> Column:
    """``' '.join(text.split())``: runs of whitespace become one space."""
    return strip(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def tokens(c: ColumnOrName) -> Column:
    """``text.split()``: whitespace tokens, empty array for a blank text.

    One regex pass: leading/trailing whitespace only yields empty strings,
    which are removed.
    """
    return F.array_remove(F.split(_col(c), r"(?U)\s+", -1), "")


def is_blank(c: ColumnOrName) -> Column:
    return strip(c) == ""


def repair_chars(c: ColumnOrName) -> Column:
    """drop CR, NUL, U+200C and U+FEFF."""
    return F.translate(_col(c), BROKEN_CHARS, "")


def split_lines(c: ColumnOrName) -> Column:
    """Split a text on ``\\n`` only, the way a file reader yields lines.

    A final ``\\n`` does not open an extra (empty) line, and a last line without
    ``\\n`` still counts.  An empty text has no lines.
    """
    parts = F.split(_col(c), "\n", -1)
    n = F.size(parts)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, n - 1)).otherwise(parts)


def split_message(c: ColumnOrName) -> Column:
    """``text.strip().split('\\n')`` as used for request messages."""
    return F.split(strip(c), "\n", -1)


def language_tag(text: ColumnOrName, tgt_lang: ColumnOrName) -> Column:
    """``<2xx> text``."""
    return F.concat(F.lit("<2"), _col(tgt_lang), F.lit("> "), strip(text))


def append_query(text: ColumnOrName) -> Column:
    """``sentence<TAB>query`` becomes ``sentence ||| query``.

    Only the first tab splits; a line without a tab is only stripped.
    """
    parts = F.split(_col(text), "\t", 2)
    return F.when(F.size(parts) == 2,
                  F.concat(strip(parts[0]), F.lit(" ||| "), strip(parts[1]))).otherwise(strip(text))


def query_terms(c: ColumnOrName) -> Column:
    """``terms.split('|||')`` with each term stripped."""
    return F.transform(F.split(strip(c), r"\|\|\|", -1), lambda t: strip(t))


def bpe_decode(c: ColumnOrName) -> Column:
    """remove the ``@@ `` continuation marks (and a dangling final ``@@``)."""
    return F.regexp_replace(_col(c), r"(@@ )|(@@ ?$)", "")


def spm_decode(c: ColumnOrName) -> Column:
    """F32: join pieces, ``▁`` becomes a space, strip."""
    return strip(F.replace(F.regexp_replace(_col(c), r"(?U)\s+", ""), F.lit("▁"), F.lit(" ")))


def detruecase(c: ColumnOrName) -> Column:
    """upper-case the first letter of the sentence."""
    s = _col(c)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30))


def count_occurrences(text: ColumnOrName, term: ColumnOrName) -> Column:
    """Non-overlapping literal occurrences, like Python ``str.count``.

    Python counts ``len(text) + 1`` for an empty term; kept as is.
    """
    t, q = _col(text), _col(term)
    return F.when(F.length(q) == 0, F.length(t) + 1).otherwise(
        F.floor((F.length(t) - F.length(F.replace(t, q, F.lit("")))) / F.length(q))).cast("long")
