import contextlib
import io
import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farebox.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="farebox-test-ckpt-", dir="/tmp")
    wh = tempfile.mkdtemp(prefix="farebox-test-wh-", dir="/tmp")
    s = get_spark("local[4]", app="farebox-tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": wh,
                         "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


def plan_text(df, mode="formatted"):
    """The physical plan as printed by ``explain``."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def write_json_lines(rows, folder, name="part-0.json"):
    """Land hand-made messages as a JSON-line file (tests: late rows etc.)."""
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")
    return p
