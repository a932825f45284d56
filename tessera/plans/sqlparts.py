"""Shared DuckDB CTE fragments for the oracle SQL.

The driver tables hold only U+0020 and ``\\n`` as whitespace, so DuckDB's
ASCII ``\\s`` / ``trim`` agree with the Unicode-aware Spark expressions there.
"""

# documents → lines (doc_id, line_no, text): split on \n, drop a final empty part.
LINES = r"""
_p AS (SELECT doc_id, string_split(translate(text, chr(13) || chr(8204) || chr(65279), ''), chr(10)) AS parts
       FROM documents),
_q AS (SELECT doc_id, CASE WHEN parts[-1] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS parts FROM _p),
lines AS (SELECT doc_id, CAST(unnest(range(0, len(parts))) AS BIGINT) AS line_no, unnest(parts) AS text FROM _q)
"""

# lines → pieces (doc_id, line_no, piece_no, n_pieces, is_empty, text), wrap at 200 tokens.
_PIECES = r"""
_t AS (SELECT doc_id, line_no, text,
              CASE WHEN trim(text) = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(trim(text), '\s+') END AS tok
       FROM {src}),
_w AS (SELECT doc_id, line_no, trim(text) = '' AS is_empty,
              CASE WHEN len(tok) > 200
                   THEN list_transform(range(0, (len(tok) - 1) // 200 + 1),
                                       lambda i: array_to_string(tok[i * 200 + 1 : i * 200 + 200], ' '))
                   ELSE [trim(text)] END AS p
       FROM _t),
pieces AS (SELECT doc_id, line_no, is_empty, CAST(len(p) AS INTEGER) AS n_pieces,
                  CAST(unnest(range(0, len(p))) AS INTEGER) AS piece_no, unnest(p) AS text FROM _w)
"""


def pieces_sql(src: str = "lines") -> str:
    return _PIECES.replace("{src}", src)


PIECES = pieces_sql("lines")


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"
