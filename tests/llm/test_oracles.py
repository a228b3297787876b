"""The registered queries whose results SQL can express."""

import pytest

from viewrecon.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"op5_line_dedup", "op9_topk_search"}))
def test_matches_oracle(spark, duck, sf_dir, name):
    mine = QUERIES[name](spark, sf_dir)
    names = sorted(mine.columns)
    theirs = duck.sql(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(tuple(r[c] for c in names) for r in mine.collect()) == sorted(theirs) and theirs
    assert names == sorted(duck.sql(ORACLES[name]).columns)
