"""Summarise stage durations from a Spark event log folder (zstd or plain)."""
import glob
import io
import json
import sys

import zstandard


def events(path):
    for f in sorted(glob.glob(f"{path}/**/events*", recursive=True)):
        with open(f, "rb") as fh:
            stream = zstandard.ZstdDecompressor().stream_reader(fh) if f.endswith(".zstd") else fh
            for line in io.TextIOWrapper(stream, encoding="utf-8", errors="replace"):
                try:
                    yield json.loads(line)
                except ValueError:
                    continue


def main(path):
    stages = {}
    for e in events(path):
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"][:60], si["Number of Tasks"],
                                      (si["Completion Time"] - si["Submission Time"]) / 1000)
    for k, v in sorted(stages.items(), key=lambda kv: -kv[1][2])[:15]:
        print(k, v)
    print("stages", len(stages), "sum", round(sum(v[2] for v in stages.values()), 2))


if __name__ == "__main__":
    main(sys.argv[1])
