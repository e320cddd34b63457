import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cartulary.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("cartulary-tests", 8)
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a one-column function to texts and return the results in order."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]

    return run


def rows(df, *cols):
    """Rows as a sorted list of tuples, NULLs first."""
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda t: [(x is not None, str(type(x)), x) if x is not None else (False, "", 0) for x in t])
