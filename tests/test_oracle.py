"""Every registered query against its DuckDB oracle on the smallest supplied tables
(the driver repeats this at sf0.01).  Queries without an oracle must still run."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF_SMALL, key, con)
    if key in oracle_sql():
        assert r["match"], r.get("why")
        assert not r["type_mismatches"], r["type_mismatches"]
    else:
        assert r["spark_rows"] >= 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["source_channel", "total", "accepted", "qualified", "qual_rate_pct"]
