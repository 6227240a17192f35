import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from metrolens.session import build_session

    tmp = tempfile.mkdtemp(prefix="metrolens-test-")
    s = build_session(master="local[4]", app="metrolens-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": os.path.join(tmp, "warehouse"),
                             "spark.checkpoint.dir": os.path.join(tmp, "ckpt")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="metrolens-t-")


def rows(df, *cols):
    """Collect a small result as sorted tuples of the given columns."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))


def plan_text(df, mode: str = "simple") -> str:
    """The physical plan as printed by df.explain (public API), captured."""
    import contextlib
    import io

    spark = df.sparkSession
    key = "spark.sql.maxMetadataStringLength"  # scan metadata is cut at 100 chars by default
    prev = spark.conf.get(key)
    spark.conf.set(key, "100000")
    buf = io.StringIO()
    try:
        with contextlib.redirect_stdout(buf):
            df.explain(mode=mode)
    finally:
        spark.conf.set(key, prev)
    return buf.getvalue()
