"""Attribution at the ends of windows, and where shares end on a tie of the last digit shown."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from mixwright.operators import attribution
from mixwright.plans.catalog import ORACLE, QUERIES

AT = dt.datetime(2024, 1, 20, 12, 0, 0, 100)
TOUCHES = "event_id int, user_id int, ts timestamp_ntz, interaction_type string, channel string"
CONVERSIONS = "conversion_id int, user_id int, ts timestamp_ntz, conversion_value double"


def test_parts_of_a_second_beyond_the_window_are_outside(spark):
    day, least = dt.timedelta(1), dt.timedelta(microseconds=1)
    rows = [(1, AT - 7 * day), (2, AT - 7 * day - least), (3, AT - day), (4, AT - day - least), (5, AT - 7 * day - 50 * least), (6, AT)]
    touches = spark.createDataFrame([(i, 1, ts, "view" if i in (3, 4) else "click", "a") for i, ts in rows], TOUCHES)
    conversions = spark.createDataFrame([(9, 1, AT, 12.0)], CONVERSIONS)
    got = attribution.eligible(touches, conversions)
    assert sorted(r.event_id for r in got.collect()) == [1, 3, 6]


def test_decay_counts_whole_days_to_the_last_touch(spark):
    rows = [(1, AT - dt.timedelta(1)), (2, AT - dt.timedelta(1) + dt.timedelta(microseconds=50)), (3, AT)]
    touches = spark.createDataFrame([(i, 1, ts, "click", "a") for i, ts in rows], TOUCHES)
    conversions = spark.createDataFrame([(9, 1, AT, 10.0)], CONVERSIONS)
    got = {r.event_id: r.credit for r in attribution.credited(attribution.eligible(touches, conversions), "time_decay", half_life_days=1.0).collect()}
    assert {i: round(c, 9) for i, c in got.items()} == {1: 2.0, 2: 4.0, 3: 4.0}


def test_shares_end_on_exact_ties(spark):
    """Nine clicks before two views, 36.49: a view's share is 1.1403125, which is summed up so whatever comes first."""
    day = dt.timedelta(1)
    rows = [(i, AT - 5 * day + dt.timedelta(hours=i), "click") for i in range(9)] + [(9, AT - day / 2, "view"), (10, AT - day / 4, "view")]
    touches = spark.createDataFrame([(i, 1, ts, kind, "a") for i, ts, kind in rows], TOUCHES)
    conversions = spark.createDataFrame([(9, 1, AT, 36.49)], CONVERSIONS)
    shares = attribution.credited(attribution.eligible(touches, conversions), "linear", view_weight=0.3)
    assert {r.c for r in shares.where("interaction_type = 'view'").select(F.round("credit", 6).alias("c")).collect()} == {1.140313}


def as_sql(spark, folder, events, name):
    """Rows of a query and of its SQL on a table of events: event_id, user_id, ts, event_type, value."""
    schema = "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string"
    spark.createDataFrame([(*e, '{"k": 3}') for e in events], schema).coalesce(1).write.parquet(f"{folder}/events.parquet")
    found = QUERIES[name](spark, str(folder))
    db = duckdb.connect()
    db.execute(f"create view events as select * from '{folder}/events.parquet/*.parquet'")
    order = lambda rows: sorted(rows, key=str)
    return order(map(tuple, found.collect())), order(db.execute(f"select {', '.join(found.columns)} from ({ORACLE[name]})").fetchall())


@pytest.mark.parametrize("name", ["attr_overlap_penalty", "attr_overlap_exponential"])
def test_a_tie_of_the_last_digit_ends_where_it_does_in_sql(spark, tmp_path, name):
    """A tenth of a sixteenth of 0.35 is 0.0021875, as a double a little less; that of 10.21 is 0.0638125."""
    events = [(100 * u + i, u, AT - dt.timedelta(hours=i + 1), "click", 1.0) for u in (1, 2) for i in range(16)]
    events += [(1, 1, AT, "purchase", 0.35), (2, 2, AT, "purchase", 10.21)]
    ours, theirs = as_sql(spark, tmp_path, events, name)
    assert len(ours) == 32 and ours == theirs


@pytest.mark.parametrize("name", ["attr_first", "attr_last", "attr_position"])
def test_ends_of_windows_and_missing_ids_as_in_sql(spark, tmp_path, name):
    """By whole seconds clicks 10 and 11 and view 30 would be inside; of two clicks at a time the one without an id is the later."""
    day, part = dt.timedelta(1), dt.timedelta(microseconds=50)
    events = [(10, 1, AT - 7 * day - part, "click"), (None, 1, AT - 2 * day, "click"), (12, 1, AT - 2 * day, "click"), (13, 1, AT - day, "view")]
    events += [(11, 2, AT - 7 * day - part, "click"), (30, 3, AT - day - part, "view"), (31, 3, AT - 7 * day, "click")]
    events += [(40, 4, AT - 3 * day, "click"), (41, 4, AT - 2 * day, "click"), (None, 4, AT - 2 * day, "click")]
    events = [(*e, 1.0) for e in events] + [(u, u, AT, "purchase", 10.0 + u) for u in (1, 2, 3, 4)]
    ours, theirs = as_sql(spark, tmp_path, events, name)
    assert ours and ours == theirs


def test_shares_by_place_end_where_they_do_in_sql(spark, tmp_path):
    """Clicks and views by time: a middle click's share of 64.38 and of 0.98 is a tie of the sixth digit, and weights summed least first put it on the other side."""
    kinds = {1: ("cccccvvvvvv", 64.38), 2: ("cccvvvcvvcv", 0.98)}
    events = [(100 * u + i, u, AT - dt.timedelta(hours=12 - i), "click" if k == "c" else "view", 1.0) for u, (ks, _) in kinds.items() for i, k in enumerate(ks)]
    events += [(u, u, AT, "purchase", value) for u, (_, value) in kinds.items()]
    ours, theirs = as_sql(spark, tmp_path, events, "attr_position")
    assert len(ours) == 22 and ours == theirs
