"""Every registered query against its SQL, at the smallest scale."""

import pytest
from compare import checking_engine, differences

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return checking_engine(FOLDER)


def test_every_query_has_sql():
    assert registry.shot_queries().keys() == registry.shot_sql().keys()


# The smallest scale has none of their rows.
MAY_BE_EMPTY = {"completed_games", "team_roster_sorted"}


@pytest.mark.parametrize("name", list(registry.shot_queries()))
def test_query(spark, engine, name):
    got = registry.shot_queries()[name](spark, FOLDER).toArrow()
    expected = engine.execute(registry.shot_sql()[name]).to_arrow_table()
    assert differences(got, expected) is None
    assert got.num_rows > 0 or name in MAY_BE_EMPTY or name.endswith("_one")
