from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerline.session import build_session  # noqa: E402
from ledgerline.sources.star import bind_fact  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    extra = {"spark.ui.showConsoleProgress": "false"}
    # Tests only: a scratch checkpoint folder when the session names none.
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerline-test-"))
    s = build_session("local[4]", app="ledgerline-tests", shuffle_partitions=8, extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def fact_small(spark):
    return bind_fact(spark, SF_SMALL)


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="ledgerline-out-")
