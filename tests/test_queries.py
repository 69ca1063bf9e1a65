import pytest
from helpers import SF, same_as_sql

from tideline.queries import ORACLES, QUERIES, flagship


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, name):
    same_as_sql(QUERIES[name](spark, SF), ORACLES[name])


def test_flagship_is_wide_and_ordered(spark):
    frame = flagship(spark, SF)
    assert len(frame.columns) == 166
    found = [r[0] for r in frame.select("observation_date").collect()]
    assert found == sorted(found) and len(set(found)) == len(found) > 0
