"""Readers for the driver tables and for folders of text documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


#: Session setting: into how many partitions a table is dealt after its scan.
#: Unset, a scan keeps its file splits; benches on one small file set it.
READ_PARTITIONS = "spark.tessera.readPartitions"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table, with the file's own splits."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    wanted = spark.conf.get(READ_PARTITIONS, None)
    return df.repartition(int(wanted)) if wanted else df


def document_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line: ``key, line_no, text`` (+ ``keep`` columns).

    The split is on ``\\n`` only; CR and other broken characters are removed
    first.  Line numbers are dense and start at 0 per document.  A narrow,
    shuffle-free projection: each document is split inside its own task.
    """
    cleaned = T.repair_chars(F.col(text))
    return (docs.select(key, *keep, F.posexplode(T.split_lines(cleaned)).alias("line_no", "text"))
                .withColumn("line_no", F.col("line_no").cast("long")))


#: Files of this many bytes or more are read line by line, by as many tasks as they have splits.
BIG_FILE = 64 << 20


def read_folder(spark: SparkSession, path: str, glob: str | None = None, big: int = BIG_FILE) -> DataFrame:
    """A recursive folder of UTF-8 files → ``doc, line_no, text``.

    ``doc`` is the path relative to ``path``.  A file below ``big`` bytes is read
    whole (the reference's many-small-files premise) and split into lines inside
    its task; a larger one is cut into splits and its lines are numbered across
    them (:func:`numbered_lines`).  Both scans choose their files by the size in
    the scan's own listing.  Files whose name begins with ``_`` or ``.`` are not
    documents, as for every Spark reader.  Spark's scans skip zero-byte files; the
    listing adds each of them as a document of one empty line, which is what an
    empty text has (see :func:`folder_listing`).
    """
    opts = {"recursiveFileLookup": True, **({"pathGlobFilter": glob} if glob else {})}
    size = F.col("_metadata.file_size")
    raw = spark.read.text(path, wholetext=True, **opts).where(size < big)
    docs = raw.select(relative_name(spark, path, F.col("_metadata.file_path")).alias("doc"), F.col("value").alias("text"))
    lines = document_lines(docs, key="doc")
    if not spark.read.format("binaryFile").options(**_options(opts)).load(path).where(F.col("length") >= big).select("length").isEmpty():
        large = numbered_lines(spark.read.text(path, lineSep="\n", **opts).where(size >= big))
        lines = lines.unionByName(large.select(relative_name(spark, path, F.col("doc")).alias("doc"), "line_no", "text"))
    empty = folder_listing(spark, path, glob).where("length = 0")
    return lines.unionByName(empty.select("doc", F.lit(0).cast("long").alias("line_no"), F.lit("").alias("text")))


def read_big_file_lines(spark: SparkSession, path: str) -> DataFrame:
    """S1 for few large files: ``\\n``-separated scan with stable line numbers; see :func:`numbered_lines`."""
    return numbered_lines(spark.read.text(path, lineSep="\n"))


def numbered_lines(raw: DataFrame) -> DataFrame:
    """``doc, line_no, text`` of a scan by lines, ``doc`` being the file's full path.

    Line numbers come from the distributed prefix-sum pattern: the scan keeps
    (file, split start, position in split); per-split counts are summed in a
    small table (one row per split) and added back as offsets.  No window
    spans a whole file, so one huge file is still read by many tasks.
    """
    rows = raw.select(F.col("_metadata.file_path").alias("doc"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("mid"),
                      T.repair_chars(F.col("value")).alias("text"))
    from tessera.operators.prefix import dense_offsets
    return dense_offsets(rows, group="doc", order=["block", "mid"], out="line_no").drop("block", "mid")


def folder_listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``doc, length`` of every file that Spark's readers see under ``path``, empty ones included.

    The names are those of the scan's own file index (listed by Spark, in
    parallel when there are many folders), one call; lengths come from a scan of
    the files' metadata, which reads no content and skips empty files.
    """
    opts = {"recursiveFileLookup": True, **({"pathGlobFilter": glob} if glob else {})}
    names = spark.createDataFrame([(n,) for n in spark.read.text(path, **opts).inputFiles()], "file string")
    scan = spark.read.format("binaryFile").options(**_options(opts)).load(path)
    full = scan.select(relative_name(spark, path, F.col("_metadata.file_path")).alias("_doc"), "length")
    listed = names.select(relative_name(spark, path, F.col("file")).alias("doc"))
    return listed.join(full, F.col("doc") == F.col("_doc"), "left").select("doc", F.coalesce("length", F.lit(0)).alias("length"))


def _options(opts: dict) -> dict:
    return {k: str(v).lower() if isinstance(v, bool) else v for k, v in opts.items()}


def relative_name(spark: SparkSession, path: str, uri) -> F.Column:
    """A file's URI (percent-encoded, as Spark gives it) as its plain path below the folder ``path``."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = one_slash(F.lit(fs.makeQualified(root).toString().rstrip("/") + "/"))
    plain = plain_name(uri)
    return F.when(F.startswith(plain, base), F.substring(plain, F.length(base) + 1, F.length(plain))).otherwise(plain)


def plain_name(uri) -> F.Column:
    """A file's percent-encoded URI as plain text with one slash after its scheme."""
    return one_slash(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))))  # url_decode takes a plus for a blank


def one_slash(uri) -> F.Column:
    """``file:///a`` and ``file:/a`` alike."""
    return F.regexp_replace(uri, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def read_vocab(spark: SparkSession, path: str, threshold: int = 0) -> DataFrame:
    """A ``token count`` vocabulary file, kept at frequency ≥ threshold."""
    v = spark.read.csv(path, sep=" ", schema="token string, n long")
    return v.filter(F.col("n") >= threshold) if threshold else v


PARSED_SCHEMA = ("id long, translation array<string>, "
                 "nbest_words array<array<map<string,string>>>")


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    """Re-read json-lines items written by a parse stage, with a fixed schema."""
    return spark.read.schema(PARSED_SCHEMA).json(path)


def read_tags(lines: DataFrame, column: str = "value") -> DataFrame:
    """A tag side file (one JSON list of [placeholder, original] per line)."""
    from tessera.operators.placeholders import TAGS_TYPE
    pairs = F.from_json(F.col(column), "array<array<string>>")
    tags = F.transform(pairs, lambda p: F.struct(p[0].alias("placeholder"), p[1].alias("original")))
    return lines.withColumn("tags", tags.cast(TAGS_TYPE))


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail early on an empty input (``isEmpty`` reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
