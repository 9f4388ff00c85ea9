import re

import pytest
from pyspark.sql import functions as F

from lotwise.operators.latest import latest_per_key, near_keys
from lotwise.plans import marts
from tests.samples import at, observations


def wide_sorts_of_rows(df):
    """Sorts for a partial aggregate of whole observations that no rebalance goes before."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(struct(observed_at" in plan
    lines = plan.splitlines()
    found = []
    for i, line in enumerate(lines):
        if "partial_max(struct(observed_at" in line:
            below = [x for x in lines[i + 1 :] if not re.search(r"- (?:\*\(\d+\) )?(Sort|Project)\b", x)]
            found.append(not ("Exchange" in below[0] and "REBALANCE_PARTITIONS_BY_COL" in below[0]))
    return sum(found)


def test_rows_are_near_their_key_before_the_latest_state_is_taken(spark):
    rows = observations(spark, {"title": "a"})
    assert wide_sorts_of_rows(marts.latest_state(rows)) == 0


def test_a_frequent_key_and_no_key_are_taken_like_others(spark):
    rows = [{"source_offer_id": "1", "observed_at": at(f"2024-01-01 10:{i % 60:02}:00"), "title": f"t{i}"} for i in range(300)]
    rows += [{"source_offer_id": str(i)} for i in range(2, 9)]
    df = observations(spark, *rows).withColumn("source_offer_id", F.expr("nullif(source_offer_id, '8')"))
    keys, order = ["source_offer_id"], ["observed_at", "scrape_run_id"]
    near = near_keys(df, keys)
    assert near.columns == df.columns and near.exceptAll(df).isEmpty() and df.exceptAll(near).isEmpty()
    plain, spread = latest_per_key(df, keys, order), latest_per_key(near, keys, order)
    assert spread.count() == 8 and plain.exceptAll(spread).isEmpty()


@pytest.mark.parametrize("name", ["c1_not_null", "c4_relationships", "c2_unique", "q3_brands", "q8_vehicles"])
def test_queries_of_offers_sort_no_rows_as_they_were_read(spark, name):
    from tests.conftest import SF_DIR
    from verification.queries import queries

    assert wide_sorts_of_rows(queries()[name](spark, SF_DIR)) == 0
