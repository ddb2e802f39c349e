import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from folioscope.session import ensure_checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("folioscope-tests", 8, 4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="folioscope-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def cell():
    """One raw cell: a number stays typed, text stays text, None stays empty."""

    def make(value):
        if value is None:
            return None
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return (None, float(value))
        return (str(value), None)

    return make


@pytest.fixture()
def holdings(spark, cell):
    from folioscope.contracts import HOLDINGS_RAW

    def make(rows):
        out = []
        for i, r in enumerate(rows):
            out.append((
                r.get("amc", "test_amc"), r.get("period", "2026-05"), r.get("source_file", "file.xlsx"),
                r.get("sheet", "Test Fund"), r.get("scheme", "Test Fund"), r.get("section"),
                r.get("name", "Some Security"), r.get("isin"), r.get("industry"),
                cell(r.get("quantity", 100)), cell(r.get("value", 50.0)), cell(r.get("pct", 100.0)),
                dt.date(2026, 5, 31), r.get("ord", i),
            ))
        return spark.createDataFrame(out, HOLDINGS_RAW).repartition(3)

    return make
