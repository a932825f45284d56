import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def raw_table(spark, text: str, file: int = 0):
    """A decoder output text → raw_out(src_file, seq, line), like a file read."""
    lines = text.split("\n")
    if lines and lines[-1] == "":
        lines = lines[:-1]
    return spark.createDataFrame([(file, i, l) for i, l in enumerate(lines)],
                                 "src_file long, seq long, line string")
