"""WARC archives and their capture index by external merge.

Pages are written as WARC records, one gzip member each, into archives in the
shared folder.  The archives are read back one by one; each gives a run of
captures, sorted by URL key and timestamp, written beside it with a sparse
offset table.  Runs are merged k ways by a loser tree that streams the lines of
one key range from each run: first groups of at most ``FAN_IN`` runs, pass by
pass, then all that are left.  A merge task holds one line and one read buffer
for each of at most ``FAN_IN`` runs, whatever their size, and key ranges are
independent tasks, so the globally ordered history is never in one place.

Files carry names of their own for each task attempt, and only those that a
successful attempt reports are read, so lost executors leave no trace.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import shared_path, staged

ARCHIVE_BYTES = 256 << 20  # of records, before compression
FAN_IN = 256
EVERY = 256  # lines between entries of a run's offset table
RANGE_LINES = 100_000  # lines a merge task is meant to have
SAMPLE = 20_000  # bound of the keys sampled to set the ranges
LEVEL = 3
EPOCH = datetime(2020, 1, 1, tzinfo=timezone.utc)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI of the shared folder."""
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def safe(text: str) -> str:
    """Control characters and blanks percent-encoded, so that a value is one field of a line."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in text)


def url_key(url: str | None) -> str:
    """Sort key of a url: host labels reversed, then path and query; ``-`` for none."""
    if not url:
        return "-"
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = min([i for i in (rest.find("/"), rest.find("?")) if i >= 0], default=len(rest))
    return safe(",".join(reversed(rest[:cut].lower().split("."))) + ")" + (rest[cut:] or "/"))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, when: datetime) -> bytes:
    """One WARC record: a response with its payload, or a revisit of page ``first`` without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'-' if page_id is None else page_id}>", f"WARC-Date: {when:%Y-%m-%dT%H:%M:%SZ}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {safe(url)}")
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{first}>"]
    head += [f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(file) -> Iterator[tuple[int, bytes]]:
    """``(offset, content)`` of the gzip members of an open file, one at a time."""
    offset, waiting = 0, b""
    while True:
        if not waiting:
            waiting = file.read(1 << 20)
            if not waiting:
                return
        member, out, used = zlib.decompressobj(31), [], 0
        while not member.eof:
            if not waiting:
                waiting = file.read(1 << 20)
                if not waiting:
                    raise EOFError("archive ends inside a record")
            out.append(member.decompress(waiting))
            used += len(waiting) - len(member.unused_data)
            waiting = member.unused_data
        yield offset, b"".join(out)
        offset += used


def read_record(raw: bytes) -> dict:
    """Fields of a record; the payload of a response is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if lines[0] != "WARC/1.1" or len(block) != int(fields["Content-Length"]) or (
            kind == "response" and (len(payload) != size or base32_sha1(payload) != digest)):
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    number = lambda x: x.removeprefix("<urn:page:").removesuffix(">")
    return {"id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "type": kind, "size": size, "digest": digest,
            "first": number(fields.get("WARC-Refers-To", "-")),
            "when": datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ"), "payload": payload}


def index_line(r: dict, archive: str, offset: int) -> bytes:
    return " ".join([url_key(r["url"]), f"{r['when']:%Y%m%d%H%M%S}", r["id"], r["type"], str(r["size"]), r["digest"],
                     r["first"], archive, str(offset)]).encode() + b"\n"


def write_run(folder: str, name: str, lines: Iterator[bytes]) -> tuple[str, int, bytes, bytes]:
    """Write sorted lines and their offset table: path, count, first and last line."""
    system, root = store(folder)
    path, count, at, first, last, table = f"{name}.cdx", 0, 0, b"", b"", []
    with system.open_output_stream(f"{root}/{path}") as out:
        for line in lines:
            if count % EVERY == 0:
                table.append(b"%d " % at + line)
            first, last = first or line, line
            out.write(line)
            at += len(line)
            count += 1
    with system.open_output_stream(f"{root}/{path}.at") as out:
        out.write(b"".join(table))
    return path, count, first, last


def read_range(folder: str, path: str, low: bytes, high: bytes) -> Iterator[bytes]:
    """Lines of a run from ``low`` (included) to ``high`` (not; empty: to the end)."""
    system, root = store(folder)
    with system.open_input_stream(f"{root}/{path}.at") as table:
        entries = [x.split(b" ", 1) for x in table.read().splitlines(keepends=True)]
    at = max(0, bisect.bisect_left([x[1] for x in entries], low) - 1)
    if not entries:
        return
    with system.open_input_file(f"{root}/{path}") as file:
        file.seek(int(entries[at][0]))
        rest = b""
        while chunk := file.read(1 << 16):
            *lines, rest = (rest + chunk).split(b"\n")
            for line in lines:
                line += b"\n"
                if high and line >= high:
                    return
                if line >= low:
                    yield line


class LoserTree:
    """k-way merge of sorted iterators: each inner node keeps the loser of its
    match, so the next smallest line costs one comparison for each level."""

    def __init__(self, sources: list[Iterator[bytes]]):
        self.sources = sources
        self.k = max(1, len(sources))
        self.heads = [next(s, None) for s in sources] or [None]
        self.losers = [0] * self.k
        self.winner = self._play(1)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, loser = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = loser
        return winner

    def __iter__(self) -> Iterator[bytes]:
        while (line := self.heads[self.winner]) is not None:
            yield line
            champion = self.winner
            self.heads[champion] = next(self.sources[champion], None)
            node = (champion + self.k) // 2
            while node:
                if self._beats(self.losers[node], champion):
                    self.losers[node], champion = champion, self.losers[node]
                node //= 2
            self.winner = champion


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", page: str = "html",
                   least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row below ``folder``; returns ``archive, records``.

    Of equal payloads of at least ``least`` bytes the smallest id is a response
    and the others revisit it.  Only digests that occur more than once are
    joined back, one row each.  A page's date is its id in seconds after 2020.
    """
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(page), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    repeats = (rows.where(F.octet_length("payload") >= least).groupBy("sha1")
                   .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("sha1").alias("_sha1"), "first"))
    joined = rows.join(staged(repeats, "repeats"), F.col("sha1") == F.col("_sha1"), "left")
    out = joined.select("page_id", "url", "payload", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("first"))
    system, root = store(folder)
    system.create_dir(root, recursive=True)

    def run(batches):
        system, root = store(folder)
        state: dict = {}

        def finish():
            if not state:
                return
            state.pop("file").close()
            yield pa.RecordBatch.from_arrays([pa.array([state["name"]]), pa.array([state["n"]])], names=["archive", "records"])
            state.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for page_id, address, payload, first in zip(*(c.to_pylist() for c in part.columns)):
                    if not state:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        state.update(name=name, n=0, size=0, file=system.open_output_stream(f"{root}/{name}", compression=None))
                    raw = record(page_id, address, payload, first, EPOCH + timedelta(seconds=(page_id or 0) % (1 << 31)))
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    state["file"].write(packer.compress(raw) + packer.flush())
                    state["n"] += 1
                    state["size"] += len(raw)
                    if state["size"] >= archive_bytes:
                        yield from finish()
        yield from finish()

    return staged(out.mapInArrow(run, "archive string, records long"), "archives")


def sorted_runs(archives: DataFrame, folder: str) -> DataFrame:
    """Read each archive back and write its captures as a sorted run: ``run, n, first, last``."""
    count = max(1, archives.count())

    def run(batches):
        system, root = store(folder)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                with system.open_input_stream(f"{root}/{archive}", compression=None) as file:
                    # one archive of captures at most: ARCHIVE_BYTES of records, without their payloads
                    lines = sorted(index_line(read_record(raw), archive, offset) for offset, raw in members(file))
                found = write_run(folder, uuid.uuid4().hex, iter(lines))
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in found], names=["run", "n", "first", "last"])

    runs = archives.select("archive").repartition(min(count, 100_000), "archive").mapInArrow(run, "run string, n long, first binary, last binary")
    return staged(runs, "runs")


def sampled_keys(runs: DataFrame, folder: str) -> list[bytes]:
    """A bounded sample of the runs' offset tables, sorted; it sets how even the
    merge tasks are, not what is merged."""
    def run(batches):
        system, root = store(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with system.open_input_stream(f"{root}/{path}.at") as table:
                    keys = [x.split(b" ", 1)[1] for x in table.read().splitlines(keepends=True)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["k"])

    keys = runs.select("run").mapInArrow(run, "k binary").orderBy(F.xxhash64("k")).limit(SAMPLE).collect()
    return sorted({bytes(r["k"]) for r in keys})


def key_edges(keys: list[bytes], parts: int) -> list[bytes]:
    """Inner edges of ``parts`` key ranges of about equal numbers of lines."""
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def merge_jobs(runs: DataFrame, edges: list[bytes], groups: int) -> DataFrame:
    """One row per group of runs and key range with the paths that reach into
    it, in tasks of their own: ``g, r, low, high, paths``."""
    def reach(batches):
        for batch in batches:
            rows = [(g, r, run) for g, run, first, last in zip(*(c.to_pylist() for c in batch.columns))
                    for r in range(bisect.bisect_right(edges, first), bisect.bisect_right(edges, last) + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.string()))] if rows else
                                             [pa.array([], t) for t in (pa.int32(), pa.int32(), pa.string())], names=["g", "r", "run"])

    group = F.pmod(F.xxhash64("run"), F.lit(groups)).cast("int")
    pairs = runs.select(group.alias("g"), "run", "first", "last").mapInArrow(reach, "g int, r int, run string")
    jobs = pairs.groupBy("g", "r").agg(F.array_sort(F.collect_list("run")).alias("paths"))  # names of the runs of one group
    return jobs.repartition(min((len(edges) + 1) * groups, 100_000), "g", "r")


def bounds(edges: list[bytes], r: int) -> tuple[bytes, bytes]:
    return ([b"", *edges][r], [*edges, b""][r])


def capture_history(archives: DataFrame, folder: str, fan_in: int = FAN_IN, range_lines: int = RANGE_LINES) -> DataFrame:
    """All captures of the archives, read back and globally ordered.

    Returns ``range, seq`` (the order), ``url_key, captured, page_id,
    record_type, payload_bytes, payload_digest, refers_to, archive, offset``.
    """
    runs = sorted_runs(archives, folder)
    keys = sampled_keys(runs, folder)
    waiting, lines = runs.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    while waiting > fan_in:
        # a pass: groups of about half of fan_in runs become one run each, in pieces by coarse key ranges
        groups = -(-2 * waiting // fan_in)
        edges = key_edges(keys, max(1, -(-lines // (groups * range_lines))))

        def fold(batches, edges=edges):
            for batch in batches:
                for g, r, paths in zip(*(c.to_pylist() for c in batch.columns)):
                    found = write_run(folder, f"{uuid.uuid4().hex}-{g}-{r}", fan(folder, *bounds(edges, r), paths, fan_in))
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in found], names=["run", "n", "first", "last"])

        pieces = merge_jobs(runs, edges, groups).mapInArrow(fold, "run string, n long, first binary, last binary")
        runs = staged(pieces, "runs").where("n > 0")
        waiting = groups  # a key meets one piece of each group
    edges = key_edges(keys, max(1, -(-lines // range_lines)))

    def last_merge(batches):
        names = ["range", "seq", "url_key", "captured", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "archive", "offset"]
        for batch in batches:
            for _, r, paths in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                for seq, line in enumerate(fan(folder, *bounds(edges, r), paths, fan_in)):
                    key, when, page_id, kind, size, digest, first, archive, offset = line.decode().rstrip("\n").split(" ")
                    rows.append((r, seq, key, when, None if page_id == "-" else int(page_id), kind, int(size), digest,
                                 None if first == "-" else int(first), archive, int(offset)))
                    if len(rows) == 4096:
                        yield as_batch(rows, names)
                        rows = []
                if rows:
                    yield as_batch(rows, names)

    return merge_jobs(runs, edges, 1).mapInArrow(last_merge, "range int, seq long, url_key string, captured string, page_id long, record_type string, "
                                       "payload_bytes long, payload_digest string, refers_to long, archive string, offset long")


def fan(folder: str, low: bytes, high: bytes, paths: list[str], fan_in: int) -> Iterator[bytes]:
    """Loser-tree merge of one key range of the given runs; trees of at most ``fan_in`` sources feed one another."""
    sources = [read_range(folder, p, low, high) for p in paths]
    while len(sources) > fan_in:
        sources = [iter(LoserTree(sources[i:i + fan_in])) for i in range(0, len(sources), fan_in)]
    return iter(LoserTree(sources))


KINDS = {"range": pa.int32(), "seq": pa.int64(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "offset": pa.int64()}


def as_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS.get(n, pa.string())) for n, c in zip(names, zip(*rows))], names=names)


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", least: int = 0,
                  folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES, fan_in: int = FAN_IN,
                  range_lines: int = RANGE_LINES) -> DataFrame:
    """Write ``pages`` as WARC archives, read them back and return the ordered
    captures (see :func:`capture_history`), one row per row of ``pages``.

    A null page counts as empty, empty payloads are equal to each other.  Rows
    of one payload that all lack an id are responses; with an id among them the
    others revisit it.  Repeated rows share their id and are all responses if it
    is the smallest.  A null url has key ``-``.  An empty table gives an empty
    result; other columns are not read.  Ids are integers.
    """
    folder = folder or shared_path(pages.sparkSession, "warc")
    archives = write_archives(pages, folder, key, url, page, least, archive_bytes)
    return capture_history(archives, folder, fan_in, range_lines)
