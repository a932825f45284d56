"""An external line filter over a corpus.

The filter is any program that reads lines and writes as many lines in the same
order (a tokeniser, a normaliser).  Each task starts it once and streams its
partition through: one thread feeds the program, one reads its answers and one
its error output, so that neither a program that answers line by line nor one
that answers at the end blocks the task.  The program has to be installed on
every executor.
"""

from __future__ import annotations

import queue
import subprocess
import threading
from collections import deque
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

QUEUED = 4  # batches waiting for the program, and blocks of its answers waiting for the task
BLOCK = 1 << 16  # bytes of answers read at a time
ERRORS = 4096  # bytes of error output that are quoted


class Child:
    """The program with its three threads; used by one task."""

    def __init__(self, command: Sequence[str]):
        pipe = subprocess.PIPE
        self.command = list(command)
        self.process = subprocess.Popen(self.command, stdin=pipe, stdout=pipe, stderr=pipe)
        self.inputs: queue.Queue = queue.Queue(QUEUED)
        self.answers: queue.Queue = queue.Queue(QUEUED)
        self.errors, self.stopped = b"", threading.Event()
        self.threads = [threading.Thread(target=t, daemon=True) for t in (self._feed, self._read, self._read_errors)]
        for t in self.threads:
            t.start()

    def _feed(self) -> None:
        broken = False
        while (data := self.inputs.get()) is not None:
            try:
                if not broken:
                    self.process.stdin.write(data)
            except (BrokenPipeError, ValueError):
                broken = True  # the program ended early; the count or its exit code tells
        try:
            self.process.stdin.close()
        except BrokenPipeError:
            pass

    def _read(self) -> None:
        lines = None
        while lines != []:
            lines = self.process.stdout.readlines(BLOCK)  # an empty list at the end
            while not self.stopped.is_set():
                try:
                    self.answers.put(lines, timeout=0.2)
                    break
                except queue.Full:
                    continue

    def _read_errors(self) -> None:
        while block := self.process.stderr.read1(BLOCK):
            self.errors = (self.errors + block)[-ERRORS:]

    def end(self) -> None:
        """Wait for the program, whose answers have all been read."""
        code = self.process.wait()
        self.threads[2].join()
        if code:
            raise RuntimeError(f"{self.command} ended with {code}: {self.errors.decode('utf-8', 'replace').strip()}")

    def stop(self) -> None:
        """Kill the program if it still runs and let all threads end."""
        self.stopped.set()
        if self.process.poll() is None:
            self.process.kill()
        while self.threads[0].is_alive():
            try:
                self.inputs.put(None, timeout=0.2)
                self.threads[0].join(0.2)
            except queue.Full:
                continue
        self.process.wait()
        for t in self.threads:
            t.join()
        for stream in (self.process.stdout, self.process.stderr):
            stream.close()


def filter_lines(lines: DataFrame, command: Sequence[str], keys: Sequence[str] = ("doc_id", "line_no"),
                 text: str = "text") -> DataFrame:
    """``keys…, text`` with each text replaced by the program's answer to it.

    ``command`` is the program and its arguments; no shell reads it.  The n-th line
    of the answer belongs to the n-th line of a task: a program that answers with
    more or fewer lines, ends with an error or writes no UTF-8 fails the job.  A
    null text is sent as an empty line and stays null; a text with a line break is
    an error, as it would be two lines.  A partition without rows starts no program.
    What waits is at most a few batches, unless the program itself keeps its
    answers back; then it is the rows of the partition.
    """
    slim = lines.select(*keys, text)

    def run(batches):
        child, waiting, answered = None, deque(), []
        sent, got, more = 0, 0, True

        def take(wait: bool) -> None:
            nonlocal got, more
            block = child.answers.get(wait)
            got, more = got + len(block), bool(block)
            answered.extend(block)

        def feed(data):
            """Answers are taken while the program is too busy to be fed."""
            while True:
                try:
                    return child.inputs.put(data, timeout=0.02)
                except queue.Full:
                    pass
                try:
                    while more:
                        take(False)
                except queue.Empty:
                    pass
                yield from finished()

        def finished():
            while waiting and len(answered) >= waiting[0].num_rows:
                batch = waiting.popleft()
                n = batch.num_rows
                found = [a.removesuffix(b"\n").decode("utf-8") for a in answered[:n]]
                del answered[:n]
                known = batch.column(batch.num_columns - 1).is_valid().to_pylist()
                column = pa.array([t if k else None for t, k in zip(found, known)], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=batch.schema.names)

        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                child = child or Child(command)
                texts = ["" if t is None else t for t in batch.column(batch.num_columns - 1).to_pylist()]
                if any("\n" in t for t in texts):
                    raise ValueError(f"a text of column {text} holds a line break")
                data = "".join(f"{t}\n" for t in texts).encode("utf-8")
                waiting.append(batch)
                sent += batch.num_rows
                yield from feed(data)
            if child is not None:
                yield from feed(None)
                while more:
                    take(True)
                    yield from finished()
                child.end()
                if got != sent:
                    raise RuntimeError(f"{list(command)} answered {sent} lines with {got}")
        finally:
            if child is not None:
                child.stop()

    return slim.mapInArrow(run, slim.schema)
