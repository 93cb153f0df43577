"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from parity import _rows, duck  # noqa: E402

from starmart.plans import registry  # noqa: E402

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    missing = set(NAMES) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_parity(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(scols, srows) == _rows(dcols, drows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["specialty_name", "total_discharges", "readmitted_patients",
                                              "readmission_rate"]
