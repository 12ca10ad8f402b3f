import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from marquee.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_root(spark):
    """A fresh folder under the session's shared checkpoint root."""
    from marquee.session import scratch_path

    return scratch_path(spark, "test")


@pytest.fixture()
def local_dir():
    """A fresh local folder for hand-written input files."""
    return tempfile.mkdtemp(prefix="marquee-test-")


def rows(df, *cols):
    """Sorted tuples of the given columns (all columns if none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def srt(expected):
    """Expected rows in the order ``rows`` returns them."""
    return sorted(expected, key=repr)
