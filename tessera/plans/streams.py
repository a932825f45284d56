"""Streaming queries.

Each query writes its input — derived from a driver table by Spark — into a
new folder under ``spark.checkpoint.dir``, drains it with an ``availableNow``
streaming query into a parquet sink (checkpointed), and returns the sink as a
DataFrame.  The batch oracle computes the same rows from the table.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as TT

from tessera.functions import text as T
from tessera.functions.processors import TextProcessor
from tessera.operators import nbest
from tessera.operators.prefix import prefix_sum
from tessera.plans.corpus import BLANKED, lines_of, lines_with_blanks
from tessera.plans.parallel import messages
from tessera.plans.registry import register
from tessera.plans.sqlparts import LINES, pieces_sql, with_
from tessera.plans.text_jobs import duck_placeholders
from tessera.session import materialize
from tessera.sources.tables import read_table
from tessera.streaming import jobs, lines, requests

LINE_SCHEMA = TT.StructType([TT.StructField("doc_id", TT.LongType()), TT.StructField("line_no", TT.LongType()),
                             TT.StructField("text", TT.StringType())])

FOLDERS = 16     # of stream_mux_demux, each with the lines of many documents


@register("stream_mux_demux", with_(LINES) + r"""
SELECT doc_id, line_no, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM lines""")
def stream_mux_demux(spark, sf_dir):
    """All lines of all documents through a streaming line-for-line
    transform (repair + whitespace collapse), written back per document, by
    document folders that many documents share."""
    base = jobs.scratch(spark, "mux")
    lines_of(spark, sf_dir).write.json(f"{base}/in")
    out = jobs.mux_demux(spark, f"{base}/in", LINE_SCHEMA, lambda c: T.collapse_ws(T.repair_chars(c)),
                         f"{base}/out", f"{base}/ckpt", folders=FOLDERS)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "line_no", "text")


@register("stream_requests", r"""
WITH m AS (SELECT conv_id, turn, text,
                  CASE WHEN role = 'user' THEN array_to_string(list_transform(string_split(trim(text), chr(10)),
                           lambda l: coalesce(string_split(trim(l), ' ')[1], '')), chr(10))
                       WHEN role = 'system' THEN 'sys' END AS query FROM conversations),
v AS (SELECT *, string_split(trim(text), chr(10)) AS lines,
             CASE WHEN query IS NULL THEN NULL ELSE string_split(trim(query), chr(10)) END AS qs FROM m),
e AS (SELECT *, CASE WHEN qs IS NOT NULL AND len(qs) <> len(lines)
                     THEN 'number of queries does not match number of lines' END AS error FROM v),
l AS (SELECT conv_id, turn, CAST(unnest(range(0, len(lines))) AS BIGINT) AS id,
             unnest(list_transform(range(1, len(lines) + 1), lambda i: CASE WHEN qs IS NULL THEN trim(lines[i])
                  ELSE trim(lines[i]) || ' ||| ' || trim(qs[i]) END)) AS line
      FROM e WHERE error IS NULL),
t AS (SELECT *, CASE WHEN trim(line) = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(trim(line), '\s+') END AS tok FROM l)
SELECT conv_id, turn, CAST(-1 AS BIGINT) AS id, NULL::VARCHAR AS translation,
       'number of queries does not match number of lines' AS error FROM e WHERE error IS NOT NULL
UNION ALL
SELECT conv_id, turn, id, CASE WHEN trim(line) = '' THEN '' WHEN len(tok) > 200 THEN array_to_string(tok, ' ')
                               ELSE line END, NULL FROM t""")
def stream_requests(spark, sf_dir):
    """JSON request messages (conversation turns) → stateless
    streaming translation → one response or error row per line/message."""
    base = jobs.scratch(spark, "requests")
    (messages(spark, sf_dir).select("conv_id", "turn", F.lit("xx").alias("src_lang"), F.lit("en").alias("tgt_lang"),
                                    "text", "query")
     .write.json(f"{base}/in"))
    stream = spark.readStream.schema(jobs.REQUEST_SCHEMA).json(f"{base}/in")
    jobs.run_available_now(jobs.translate_requests(stream), f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").select("conv_id", "turn", "id", "translation", "error")


def document_requests(spark, sf_dir):
    """D11 requests from documents: the text, its language, and as query the first
    word of every line (every seventh document sends one query line, every fifth none)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    first = F.transform(T.split_message("text"), lambda l: F.coalesce(F.get(F.split(T.strip(l), " "), 0), F.lit("")))
    query = F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 7 == 3, F.lit("one")).otherwise(
        F.array_join(first, "\n"))
    return docs.select(F.col("doc_id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.col("lang").alias("src_lang"),
                       F.lit("en").alias("tgt_lang"), "text", query.alias("query"))


#: English requests: queries, tags, two ranks.  German and Spanish: target tag, word lists.  French: no system.
_TAGGING = requests.System(TextProcessor("LanguageTag", pre_piece=lambda p: T.language_tag(p, F.lit("en")),
                                         post=lambda c: F.regexp_replace(c, "<2en> ?", "")), words=True)
SYSTEMS = {"en-en": requests.System(TextProcessor("Query", pre=T.append_query), n_best=2, extract_tags=True, takes_query=True),
           "de-en": _TAGGING, "es-en": _TAGGING}
REQUEST_LENGTH = 40


def _test_decoder():
    """Stand-in model: the piece, then its words backwards; every position offers its word only."""
    def words(text):
        return [{w: -0.5} for w in text.split()] + [{"</s>": -0.1}]

    def decode(system, texts, n_best):
        return [[(h, words(h)) for h in (t, " ".join(reversed(t.split())))[:n_best]] for t in texts]
    return decode


@register("stream_systems", r"""
WITH m AS (SELECT doc_id, lang, string_split(trim(text, ' ' || chr(10)), chr(10)) AS lines FROM documents),
q AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 3 THEN ['one']
                     ELSE list_transform(lines, lambda l: coalesce(string_split(trim(l), ' ')[1], '')) END AS qs FROM m),
e AS (SELECT *, CASE WHEN lang NOT IN ('en', 'de', 'es') THEN 'no system translates this pair of languages'
                     WHEN lang = 'en' AND qs IS NOT NULL AND len(qs) <> len(lines)
                     THEN 'number of queries does not match number of lines' END AS error,
             CASE WHEN lang IN ('de', 'es') AND qs IS NOT NULL
                  THEN 'query guided translation is not supported by this system, query ignored' END AS warning FROM q),
src AS (SELECT doc_id, lang, warning, unnest(range(0, len(lines))) AS id, unnest(lines) AS t, unnest(lines) AS raw,
               unnest(list_transform(range(1, len(lines) + 1), lambda i: CASE WHEN lang = 'en' THEN qs[i] END)) AS query
        FROM e WHERE error IS NULL),
""" + duck_placeholders("src") + r""",
l AS (SELECT doc_id, lang, warning, id, trim(raw) = '' AS is_empty, CASE WHEN lang = 'en' THEN tags ELSE [] END AS tags,
             CASE WHEN lang <> 'en' THEN trim(raw) WHEN query IS NULL OR trim(query) = '' THEN trim(t)
                  WHEN trim(t) = '' THEN trim(query) ELSE trim(t) || ' ||| ' || trim(query) END AS line FROM ph4),
k AS (SELECT *, CASE WHEN line = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(line, '\s+') END AS tok FROM l),
p AS (SELECT *, CASE WHEN len(tok) > 40 THEN list_transform(range(0, (len(tok) - 1) // 40 + 1),
                          lambda i: array_to_string(tok[i * 40 + 1 : i * 40 + 40], ' ')) ELSE [line] END AS pieces,
             CASE WHEN len(tok) > 40 THEN list_transform(range(0, (len(tok) - 1) // 40 + 1), lambda i: tok[i * 40 + 1 : i * 40 + 40])
                  ELSE [tok] END AS toks FROM k),
r AS (SELECT *, unnest(CASE WHEN lang = 'en' THEN [0, 1] ELSE [0] END) AS rank FROM p),
h AS (SELECT *, CASE WHEN rank = 0 THEN array_to_string(list_transform(pieces, lambda x: trim(x)), ' ')
                     ELSE array_to_string(list_transform(toks, lambda x: array_to_string(list_reverse(x), ' ')), ' ') END AS joined,
             array_to_string(flatten(list_transform(toks, lambda x: list_concat(['<2en>=-0.5'],
                 list_transform(x, lambda w: w || '=-0.5'), ['</s>=-0.1']))), ' | ') AS w FROM r)
SELECT doc_id AS conv_id, CAST(0 AS BIGINT) AS turn, CAST(-1 AS BIGINT) AS id, CAST(0 AS INTEGER) AS rank,
       NULL::VARCHAR AS translation, NULL::VARCHAR AS words, warning, error FROM e WHERE error IS NOT NULL
UNION ALL
SELECT doc_id, CAST(0 AS BIGINT), CAST(id AS BIGINT), CAST(rank AS INTEGER),
       CASE WHEN is_empty THEN '' ELSE list_reduce(tags, lambda acc, x: CASE WHEN position(x.placeholder IN acc) > 0
           THEN left(acc, position(x.placeholder IN acc) - 1) || x.original
                || substr(acc, position(x.placeholder IN acc) + length(x.placeholder))
           ELSE acc || ' ' || x.original END, joined) END,
       CASE WHEN lang = 'en' THEN NULL WHEN is_empty THEN '' ELSE w END, warning, NULL FROM h""")
def stream_systems(spark, sf_dir):
    """JSON requests for several systems in one stateless stream: queries
    (or a warning), tags, processor, wrapping and n-best ranks by system; error rows."""
    base = jobs.scratch(spark, "systems")
    document_requests(spark, sf_dir).write.json(f"{base}/in")
    stream = spark.readStream.schema(jobs.REQUEST_SCHEMA).json(f"{base}/in")
    out = requests.serve(stream, SYSTEMS, _test_decoder, REQUEST_LENGTH)
    jobs.run_available_now(out, f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").select(
        "conv_id", "turn", "id", "rank", "translation", nbest.canonical_words(F.col("nbest_words")).alias("words"),
        "warning", "error")


def _two_best():
    """Stand-in model: the piece, then its words backwards."""
    return lambda texts: [[t, " ".join(reversed(t.split()))] for t in texts]


LINE_LENGTH = 25


@register("stream_lines", with_(LINES, BLANKED, pieces_sql("blanked").replace("200", str(LINE_LENGTH))) + r"""
, t AS (SELECT *, CASE WHEN trim(text) = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(trim(text), '\s+') END AS wt FROM pieces)
SELECT doc_id, line_no, CAST(r AS INTEGER) AS rank, CASE WHEN bool_or(is_empty) THEN ''
       ELSE string_agg(CASE WHEN r = 0 THEN trim(text) ELSE array_to_string(list_reverse(wt), ' ') END, ' ' ORDER BY piece_no) END
       AS translation
FROM t, (SELECT unnest([0, 1]) AS r) GROUP BY doc_id, line_no, r""")
def stream_lines(spark, sf_dir):
    """Document lines (some blank) as a stream → pieces → 2-best decoder → lines,
    collected in several batches with a table of waiting pieces between them."""
    base = jobs.scratch(spark, "lines")
    lines_with_blanks(spark, sf_dir).write.json(f"{base}/in")
    stream = spark.readStream.schema(LINE_SCHEMA).json(f"{base}/in")
    return lines.translate_stream(spark, stream, base, _two_best, 2, max_length=LINE_LENGTH, files_per_batch=3)


@register("stream_join", r"""
SELECT event_id AS request_id, user_id, event_type, upper(event_type) AS payload,
       CAST(round(value * 1000) AS BIGINT) AS latency_ms
FROM events WHERE value >= 0 AND value <= 300""")
def stream_join(spark, sf_dir):
    """Requests (events) and their results (arriving ``value``
    seconds later) as two streams, joined with watermarks and a 5-minute
    time bound."""
    base = jobs.scratch(spark, "join")
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("req_ts"), "user_id",
        "event_type", "value")
    ev.select("request_id", "req_ts", "user_id", "event_type").write.parquet(f"{base}/requests")
    (ev.select("request_id",
               F.expr("req_ts + make_dt_interval(0, 0, 0, CAST(value AS DECIMAL(18, 6)))").alias("res_ts"),
               F.upper("event_type").alias("payload"), "value")
     .write.parquet(f"{base}/results"))
    req = spark.readStream.schema("request_id long, req_ts timestamp, user_id long, event_type string") \
        .parquet(f"{base}/requests")
    res = spark.readStream.schema("request_id long, res_ts timestamp, payload string, value double") \
        .parquet(f"{base}/results")
    joined = jobs.correlate(req, res).select(
        F.col("q.request_id").alias("request_id"), "user_id", "event_type", "payload",
        F.round(F.col("value") * 1000).cast("long").alias("latency_ms"))
    jobs.run_available_now(joined, f"{base}/out", f"{base}/ckpt", state_partitions=0)
    return spark.read.parquet(f"{base}/out")


@register("stream_sentence_ids", with_(LINES) + """
SELECT d.source, l.doc_id, l.line_no,
       CAST(row_number() OVER (PARTITION BY d.source ORDER BY l.doc_id, l.line_no) - 1 AS BIGINT) AS sent_id
FROM lines l JOIN documents d USING (doc_id)""")
def stream_sentence_ids(spark, sf_dir):
    """Dense running sentence ids per source stream, carried across
    micro-batches.  The lines arrive in two deliveries, split at the middle of
    the id range; rows without an id come first, like everywhere in Spark."""
    base = jobs.scratch(spark, "ids")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    # stage tables without the texts, which many branches would split again
    lines = materialize(lines_of(spark, sf_dir).select("doc_id", "line_no")).join(docs, "doc_id")
    per_doc = lines.groupBy("doc_id").agg(F.max("line_no").alias("_last"))
    # one order over documents and lines: first line of the document, then the line in it
    offsets = prefix_sum(per_doc.withColumn("_n", F.col("_last") + 1), "doc_id", "_n", "_first").select("doc_id", "_first")
    placed = materialize(lines.join(offsets, "doc_id").withColumn("place", F.col("_first") + F.col("line_no")).drop("_first"))
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    late = F.col("doc_id") > ((low or 0) + (high or 0)) // 2
    for part in (placed.where(~late), placed.where(late)):
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("doc_id long, line_no long, source string, place long").parquet(f"{base}/in")
        jobs.number_lines(stream, "source", "place", f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").select("source", "doc_id", "line_no", "sent_id")
