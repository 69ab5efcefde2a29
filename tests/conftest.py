import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labrelay.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="labrelay-tests-")
    s = local_session(4, 4, scratch=os.path.join(scratch, "ckpt"))
    yield s


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="labrelay-run-")


def raw_frame(spark, messages, start=0):
    """Messages (str, bytes or None) -> raw message table (partition, offset, value)."""
    rows = []
    for i, m in enumerate(messages):
        if isinstance(m, str):
            m = m.encode("utf-8")
        rows.append((0, start + i, None if m is None else bytearray(m)))
    return spark.createDataFrame(rows, "partition int, offset long, value binary")


def seg(*lines, sep="\r"):
    return sep.join(lines)
