"""Ranking, discounts, variance and growth on literal rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.functions.costs import DiscountPolicy
from ledgerlens.operators import audit, growth, ranking

JAN, FEB, MAR = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
BASE = "month date, product_code string, usage_amount double, net_cost double, gross_cost double"


@pytest.fixture
def base(spark):
    return lambda rows: spark.createDataFrame(rows, BASE)


def ranked(n, month=JAN, gross=100.0):
    return [(month, f"p{i}", float(1000 - i), 50.0, gross) for i in range(n)]


def top(df):
    return {row.product_code for row in df.where("is_top5").collect()}


def by_product(df):
    return {row.product_code: row for row in df.collect()}


def test_five_leaders(base):
    assert top(ranking.rank_top_flag(base(ranked(9)))) == {"p0", "p1", "p2", "p3", "p4"}


def test_fewer_than_five_products_are_all_leaders(base):
    assert len(top(ranking.rank_top_flag(base(ranked(3))))) == 3


def test_tie_at_rank_five_keeps_both(base):
    rows = ranked(5) + [(JAN, "tied", 996.0, 1.0, 1.0), (JAN, "low", 1.0, 1.0, 1.0)]
    assert top(ranking.rank_top_flag(base(rows))) == {"p0", "p1", "p2", "p3", "p4", "tied"}


def test_ties_above_use_up_ranks(base):
    rows = [(JAN, f"t{i}", 9.0, 1.0, 1.0) for i in range(6)] + [(JAN, "next", 8.0, 1.0, 1.0)]
    assert "next" not in top(ranking.rank_top_flag(base(rows)))


def test_null_usage_ranks_last(base):
    rows = ranked(5) + [(JAN, "none", None, 1.0, 1.0)]
    assert "none" not in top(ranking.rank_top_flag(base(rows)))
    assert "none" in top(ranking.rank_top_flag(base(rows[1:])))


def test_null_month_is_kept_but_never_a_leader(base):
    out = ranking.rank_top_flag(base([(None, "p", 9.0, 1.0, 1.0)])).collect()
    assert [row.is_top5 for row in out] == [False]


def test_null_product_takes_a_rank_but_gets_no_flag(base):
    rows = ranked(5) + [(JAN, None, 5000.0, 1.0, 1.0)]
    assert top(ranking.rank_top_flag(base(rows))) == {"p0", "p1", "p2", "p3"}


@pytest.mark.parametrize("seed", [1, 2, 64])
@pytest.mark.parametrize("k", [1, 5, 40, 41])
def test_flag_equals_join_and_brute_force(base, seed, k):
    rng = random.Random(7 * k + seed)
    rows = [
        (month, None if i == 0 else f"p{i}", rng.choice([None, *map(float, range(12))]), 1.0, 1.0)
        for month in (None, JAN, FEB, MAR)
        for i in range(40)
    ]
    expected = set()
    for month in (JAN, FEB, MAR):
        here = [(r[1], float("-inf") if r[2] is None else r[2]) for r in rows if r[0] == month]
        for product, amount in here:
            if product is not None and sum(other > amount for _, other in here) < k:
                expected.add((month, product))
    df = base(rows)
    by_threshold = ranking.rank_top_flag(df, k)
    by_join = ranking.join_top_flag(df, ranking.top_products(df, k))
    for flagged in (by_threshold, by_join):
        assert flagged.count() == len(rows)
        assert {(r.month, r.product_code) for r in flagged.where("is_top5").collect()} == expected


def test_usage_that_is_not_a_number_ranks_first(base):
    rows = ranked(5) + [(JAN, "nan", float("nan"), 1.0, 1.0), (JAN, "also", float("nan"), 1.0, 1.0)]
    df = base(rows)
    assert top(ranking.rank_top_flag(df)) == {"nan", "also", "p0", "p1", "p2"}
    assert top(ranking.join_top_flag(df, ranking.top_products(df))) == {"nan", "also", "p0", "p1", "p2"}


def test_products_that_are_all_tied_do_not_meet_in_one_task(spark):
    """100,000 products of a month with one usage: all lead, and the window gets k rows of each task."""
    ties = spark.range(0, 100_000, 1, 8).select(
        F.date_add(F.lit(JAN), (F.col("id") % 1).cast("int")).alias("month"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("product_code"), F.lit(7.0).alias("usage_amount"),
        F.lit(1.0).alias("net_cost"), F.lit(1.0).alias("gross_cost"),
    )
    flagged = ranking.rank_top_flag(ties)
    assert flagged.where("is_top5").count() == 100_000
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan[plan.index("Exchange hashpartitioning(month") :].splitlines()
    assert any("row_number(), 5, Partial" in line for line in below[1:3])
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_discount_tiers(base):
    rows = ranked(5, gross=50000.0) + [
        (JAN, "large", 1.0, 1.0, 50000.5), (JAN, "edge", 1.0, 1.0, 50000.0), (JAN, "none", 1.0, 1.0, None),
        (JAN, "big_top", 9999.0, 1.0, 100000.0),
    ]
    out = by_product(audit.audit_of(base(rows)))
    assert out["big_top"].expected_cost == 0.56 * 100000.0
    assert out["p0"].expected_cost == 0.7 * 50000.0
    assert out["large"].expected_cost == 0.8 * 50000.5
    assert out["edge"].expected_cost == 50000.0
    assert out["none"].expected_cost is None


def test_discount_policy_is_a_parameter(base):
    policy = DiscountPolicy(large_above=10.0, top_and_large=0.5)
    assert by_product(audit.audit_of(base(ranked(1)), policy=policy))["p0"].expected_cost == 50.0


def test_variance(base):
    rows = [(None, "zero", 1.0, 5.0, 0.0), (None, "edge", 1.0, 11.0, 10.0), (None, "over", 1.0, 11.5, 10.0),
            (None, "under", 1.0, 8.0, 10.0), (None, "null", 1.0, None, 10.0)]
    out = by_product(audit.audit_of(base(rows)))
    assert (out["zero"].diff_abs, out["zero"].diff_pct, out["zero"].needs_review) == (5.0, None, None)
    assert (out["edge"].diff_pct, out["edge"].needs_review) == (0.1, False)
    assert (out["over"].diff_pct, out["over"].needs_review) == (0.15, True)
    assert (out["under"].diff_abs, out["under"].needs_review) == (-2.0, True)
    assert (out["null"].diff_abs, out["null"].needs_review) == (None, None)


GROSS_ROW = dict.fromkeys(schemas.GROSS_COST.fieldNames())


def gross_row(**values):
    return tuple((GROSS_ROW | values).values())


def test_base_sums_matched_rows_by_month(spark):
    rows = [
        gross_row(start_date=dt.date(2024, 1, 31), product_code="a", usage_amount=1.0, net_cost=2.0, gross_cost=4.0, has_price_match=True),
        gross_row(start_date=dt.date(2024, 1, 1), product_code="a", usage_amount=2.0, has_price_match=True),
        gross_row(start_date=dt.date(2024, 1, 1), product_code="a", usage_amount=64.0, has_price_match=False),
        gross_row(product_code="a", usage_amount=8.0, has_price_match=True),
    ]
    out = audit.product_month_base(spark.createDataFrame(rows, schemas.GROSS_COST)).collect()
    assert sorted((str(r.month), r.usage_amount, r.net_cost, r.gross_cost) for r in out) == [
        ("2024-01-01", 3.0, 2.0, 4.0), ("None", 8.0, None, None)]


def test_audit_layout(spark):
    empty = spark.createDataFrame([], schemas.GROSS_COST)
    assert [(f.name, f.dataType) for f in audit.cost_audit(empty).schema] == [
        (f.name, f.dataType) for f in schemas.COST_AUDIT]


def test_preaggregated_equals_row_by_row(spark):
    """Fan-out, NULL measures, zero and missing factors; amounts are exact in binary."""
    rng = random.Random(3)
    billing = spark.createDataFrame(
        [
            (None, rng.choice([None, "m5"]), rng.choice([None, 0.25, 3.0]), "od", rng.choice(["U0", "U1", "U2", None]),
             rng.choice(["a", "b", None]), "n", "r", "s", rng.choice([None, JAN, FEB]), "t",
             rng.choice([None, -1.0, 2.0, 8.0]), "u")
            for _ in range(400)
        ],
        schemas.BILLING,
    )
    prices = spark.createDataFrame(
        [(c, "n", "od", u, i, p) for c in "ab" for u in ("U0", "U1", "U2") for i in (None, "m5") for p in (2.0, None, 5.0)],
        schemas.PRICES,
    )
    factors = spark.createDataFrame([("U0", 4.0), ("U1", 0.0)], schemas.UNIT_FACTOR)
    from ledgerlens.operators.matching import billing_with_gross_cost

    direct = audit.cost_audit(billing_with_gross_cost(billing, prices, factors))
    early = audit.cost_audit_from_usage(billing, prices, factors)
    assert sorted(map(str, direct.collect())) == sorted(map(str, early.collect()))
    assert direct.count() == 6


@pytest.fixture
def growth_rows(spark):
    def build(rows):
        df = spark.createDataFrame(rows, "start_date date, service_code string, net_cost double")
        return {(r.service_code, r.month): r for r in growth.service_growth(df).collect()}

    return build


def test_growth_compares_with_previous_existing_month(growth_rows):
    out = growth_rows([(JAN, "s", 4.0), (dt.date(2024, 3, 9), "s", 5.0), (dt.date(2024, 3, 10), "s", 1.0)])
    row = out["s", MAR]
    assert (row.net_cost, row.prev_net_cost, row.growth_abs, row.growth_pct) == (6.0, 4.0, 2.0, 50.0)


def test_first_month_has_no_growth(growth_rows):
    row = growth_rows([(JAN, "s", 4.0)])["s", JAN]
    assert (row.prev_net_cost, row.growth_abs, row.growth_pct) == (None, None, None)


def test_zero_base_has_no_percentage(growth_rows):
    row = growth_rows([(JAN, "s", 0.0), (FEB, "s", 3.0)])["s", FEB]
    assert (row.growth_abs, row.growth_pct) == (3.0, None)


def test_null_month_comes_first_and_null_service_is_left_out(growth_rows):
    out = growth_rows([(JAN, "s", 4.0), (None, "s", 2.0), (JAN, None, 1.0)])
    assert set(out) == {("s", None), ("s", JAN)}
    assert out["s", JAN].prev_net_cost == 2.0


def test_all_null_costs_sum_to_null(growth_rows):
    row = growth_rows([(JAN, "s", None), (FEB, "s", 3.0)])["s", FEB]
    assert (row.prev_net_cost, row.growth_abs) == (None, None)
