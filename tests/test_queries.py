"""Every registered query against its SQL at the smallest scale, and the driver's contract."""

from __future__ import annotations

import decimal
import math
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

from meridia import plans  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for p in Path(SF).iterdir():
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(x):
    if isinstance(x, (list, tuple)):
        return [plain(v) for v in x]
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, bool) or x is None:
        return str(x)
    if isinstance(x, (int, float)):
        return "None" if isinstance(x, float) and math.isnan(x) else f"{float(x):.7g}"
    return str(x)


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_agrees_with_sql(spark, oracle, name):
    df = plans.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(str([plain(v) for v in r]) for r in df.select(*cols).collect())
    rel = oracle.sql(plans.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    assert got == sorted(str([plain(v) for v in r]) for r in rel.select(", ".join(f'"{c}"' for c in cols)).fetchall())


def test_driver_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
