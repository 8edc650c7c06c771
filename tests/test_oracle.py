"""Every registered query with an oracle matches DuckDB on the same Parquet tables (sf0.001)."""

import pytest

from tests.conftest import SF_SMALL
from tools.check_oracle import duck, frame_hash
from tabrisk.plans.registry import ORACLE, QUERIES, load_all

load_all()

SQL = ORACLE
NAMES = sorted(SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    sp = QUERIES[name](spark, SF_SMALL).toPandas()
    dk = duck(SF_SMALL, SQL[name])
    assert len(sp) == len(dk)
    assert sorted(sp.columns) == sorted(dk.columns)
    assert frame_hash(sp) == frame_hash(dk)


def test_every_query_registered_has_callable():
    q = QUERIES
    assert set(SQL) <= set(q)
    assert len(q) >= 90
