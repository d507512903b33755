import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rollbook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="rollbook-tests-")
    session = local_session("4", **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply SQL expressions to rows of values: ``evaluate(expr, values)``."""

    def run(expression, rows, schema="v string"):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        numbered = [(i, *r) for i, r in enumerate(rows)]
        df = spark.createDataFrame(numbered, f"_i int, {schema}")
        found = df.selectExpr("_i", f"{expression} AS x").orderBy("_i").collect()
        return [r["x"] for r in found]

    return run
