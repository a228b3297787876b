"""Every registered query of the reconciliation engine against its SQL."""

import pytest

from viewrecon.plans.catalog import ORACLES, QUERIES


def rows(names, found):
    return sorted(repr(tuple(r[n] for n in names)) for r in found)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, sf_dir, name):
    mine = QUERIES[name](spark, sf_dir)
    other = duck.sql(ORACLES[name])
    names = sorted(mine.columns)
    assert names == sorted(other.columns)
    theirs = [dict(zip(other.columns, r, strict=True)) for r in other.fetchall()]
    assert rows(names, mine.collect()) == rows(names, theirs)


def test_state_counts_known(spark, sf_dir):
    counts = {r.state: r.records for r in QUERIES["reconcile_state_counts"](spark, "/root/testdata/sf0.001").collect()}
    assert counts == {"CONSISTENT": 1104, "INCONSISTENT": 20, "MISSING_IN_BASE_TABLE": 22, "MISSING_IN_MV_TABLE": 19, "SKIPPED": 364}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
