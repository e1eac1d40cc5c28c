"""Plan shape: no hidden actions, no global single-task window, pushdown, bounded broadcasts."""

import pytest
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from conftest import SF001
from crashlens.plans import analyses as A
from crashlens.plans import variants as V
from crashlens.plans.operator_queries import OPERATOR_QUERIES, op_filter_eq


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The plan that ran: equal exchanges once, branches that turned out empty gone."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def _forbid_actions(monkeypatch):
    def forbidden(*_a, **_k):
        raise AssertionError("action while building a plan")

    for name in ("collect", "count", "first", "take", "toPandas", "head", "toLocalIterator", "checkpoint"):
        monkeypatch.setattr(DataFrame, name, forbidden)


EAGER = {"op_dense_rank", "op_row_number", "op_rank_band_wide"}  # they fix their range partitions by a checkpoint
OPS = {n: f for n, f in OPERATOR_QUERIES.items() if n not in EAGER}

ALL = [getattr(A, n) for n in dir(A) if n[:1] == "a" and n[1:3].isdigit()] + \
      [getattr(V, n) for n in V.__all__ if n.startswith("a")]


@pytest.mark.parametrize("fn", ALL, ids=lambda f: f.__name__)
def test_building_an_analysis_runs_no_action(tables, monkeypatch, fn):
    _forbid_actions(monkeypatch)
    assert isinstance(fn(tables), DataFrame)


@pytest.mark.parametrize("name", sorted(OPS))
def test_building_an_operator_query_runs_no_action(spark, monkeypatch, name):
    _forbid_actions(monkeypatch)
    assert isinstance(OPS[name](spark, SF001), DataFrame)


def test_numbering_has_no_single_task_over_all_rows(spark):
    p = plan(OPERATOR_QUERIES["op_row_number"](spark, SF001))
    assert "SinglePartition" not in p


def test_a06_has_no_global_window_over_all_rows(tables):
    p = plan(A.a06_makes_injury_rank_3_5(tables))
    assert "SinglePartition" not in p
    assert "TakeOrderedAndProject(limit=5" in p
    # the direct form would move every row into one task
    direct = A.with_total(tables.units).distinct().withColumn(
        "r", F.dense_rank().over(Window.orderBy(F.col(A.TOTAL).desc())))
    assert "SinglePartition" in plan(direct)


def test_a10_is_one_plan_with_bounded_broadcast_semi_joins(tables):
    p = executed(A.a10_speeding_makes_top_colour_state(tables))
    # colours and states, once for the vehicles and once below the people's wide
    # distinct (Spark reuses the equal exchanges), and the people's own
    assert p.count("LeftSemi") <= 5
    assert "TakeOrderedAndProject(limit=10" in p and "TakeOrderedAndProject(limit=25" in p


def test_a07_dedups_each_side_before_the_join(tables):
    p = plan(A.a07_ethnicity_per_body(tables))
    # the join sees per-key counts, not whole rows
    assert "_nl" in p and "_nr" in p


def test_filters_and_columns_reach_the_parquet_scan(spark):
    p = plan(op_filter_eq(spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p
    assert "o_orderdate" not in p  # pruned column never read


def test_a03_top_k_is_take_ordered(tables):
    assert "TakeOrderedAndProject(limit=5" in plan(A.a03_top_makes_no_airbag(tables))


# Row exchanges per analysis when Spark may broadcast only what a limit bounds
# (the plan at scale). The budget guards against plans that add shuffles.
SHUFFLE_BUDGET = {
    "a01_crashes_male_deaths": (2, 0), "a02_two_wheelers": (1, 0), "a03_top_makes_no_airbag": (4, 0),
    "a04_hit_and_run_licensed": (3, 0), "a05_state_non_female": (1, 0), "a06_makes_injury_rank_3_5": (2, 1),
    "a07_ethnicity_per_body": (8, 0), "a08_zips_alcohol": (5, 0), "a09_no_damage_high_severity": (4, 0),
    "a10_speeding_makes_top_colour_state": (9, 4),
}


def test_shuffle_budget_at_scale(spark, tables):
    from crashlens.plans.registry import ANALYSIS_FUNCTIONS

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "2048")  # only sets whose limit bounds them fall below
    try:
        for name, (shuffles, broadcasts) in SHUFFLE_BUDGET.items():
            lines = executed(ANALYSIS_FUNCTIONS[name](tables)).splitlines()
            row_exchanges = [ln for ln in lines if "Exchange" in ln and "Broadcast" not in ln and "Reused" not in ln]
            assert len(row_exchanges) <= shuffles, (name, len(row_exchanges))
            # the empty broadcast of doubted fingerprints may stay in the plan
            assert sum("BroadcastExchange" in ln and "Reused" not in ln for ln in lines) <= broadcasts + 2, name
    finally:
        spark.conf.set(key, before)
