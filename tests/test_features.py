import math

import pytest
from pyspark.sql import functions as F

from basketry.functions.expressions import octant_label, quantile_bin, rule_segment
from basketry.operators import churn, cleaning, daily, inventory, rfm, segmentation


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}


def test_flags_and_null_rules(lines):
    raw = lines(
        {"invoice": "C100", "stock_code": "1"},
        {"invoice": "c100", "stock_code": "post"},
        {"invoice": "100", "stock_code": "POST", "quantity": -1},
        {"invoice": "101", "quantity": None},
        {"invoice": "102", "description": None},
        {"invoice": "C103", "stock_code": "POST", "quantity": -1},
    )
    flagged = cleaning.flag_lines(cleaning.dedupe(raw))
    got = rows_by(flagged, "invoice")
    assert [got[i]["is_cancellation"] for i in ("C100", "c100", "100")] == [True, False, False]
    assert [got[i]["is_admin_code"] for i in ("c100", "100", "101")] == [True, True, False]
    assert got["102"]["description"] == "UNKNOWN"
    assert {r["invoice"] for r in cleaning.completed_sales(flagged).collect()} == {"102"}
    assert cleaning.excluded_sales(flagged).count() == 5
    reasons = {r["reason"]: r["n_lines"] for r in cleaning.exclusion_reasons(flagged).collect()}
    assert reasons["cancellation"] == 2 and reasons["admin_code"] == 2


def test_dedupe_compares_all_columns(lines):
    raw = lines({}, {}, {"source_sheet": "b"})
    assert cleaning.dedupe(raw).count() == 2
    others = [c for c in raw.columns if c != "source_sheet"]
    assert cleaning.dedupe(raw, others).count() == 1


def test_rfm_counts_elapsed_days(sales):
    table = rfm.compute_rfm(
        sales(
            {"invoice_date": "2011-12-08 13:00:00", "invoice": "1", "unit_price": 2.5},
            {"invoice_date": "2011-12-08 13:00:00", "invoice": "1", "unit_price": 1.25},
        ),
        "2011-12-10 12:50:00",
    ).first()
    assert (table["recency_days"], table["frequency"], float(table["monetary"])) == (1, 1, 3.75)


def test_quantile_bins(spark):
    df = spark.range(1, 13).select(quantile_bin(F.col("id"), F.lit(12).cast("long"), 5).alias("bin"))
    assert [r["count"] for r in df.groupBy("bin").count().orderBy("bin").collect()] == [3, 2, 2, 2, 3]
    one = spark.range(1, 2).select(quantile_bin(F.col("id"), F.lit(1).cast("long"), 5).alias("b"))
    assert one.first()["b"] == 1


def test_scores_break_ties_by_customer(sales):
    table = rfm.add_rfm_scores(rfm.compute_rfm(sales(*[{"customer_id": i, "invoice": str(i)} for i in range(12)])))
    got = rows_by(table, "customer_id")
    assert [got[i]["f_score"] for i in range(12)] == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 5]
    assert [got[i]["r_score"] for i in range(12)] == [5, 5, 5, 4, 4, 3, 3, 2, 2, 1, 1, 1]


@pytest.mark.parametrize(
    ("scores", "name"),
    [
        ((5, 1, 5), "new_customers"), ((1, 5, 5), "at_risk_high_value"), ((3, 3, 3), "regular"),
        ((4, 4, 4), "champions"), ((2, 2, 5), "lost"),
    ],
)
def test_rule_segments(spark, scores, name):
    r, f, m = (F.lit(v) for v in scores)
    assert spark.range(1).select(rule_segment(r, f, m).alias("s")).first()["s"] == name


def test_octants(spark):
    flags = spark.createDataFrame([(True, False, True), (False, False, False)], "a boolean, b boolean, c boolean")
    names = [r["n"] for r in flags.select(octant_label(F.col("a"), F.col("b"), F.col("c")).alias("n")).collect()]
    assert names == ["promising_big_spenders", "lost"]


def test_missing_days_are_zero(sales):
    table = daily.daily_aggregates(
        sales({"invoice_date": "2011-01-01 10:00:00"}, {"invoice_date": "2011-01-03 10:00:00", "quantity": 4})
    )
    got = {str(r["date"]): (r["quantity"], r["n_invoices"], r["n_customers"]) for r in table.collect()}
    assert got == {"2011-01-01": (1, 1, 1), "2011-01-02": (0, 0, 0), "2011-01-03": (4, 1, 1)}


def test_rolling_waits_for_a_full_window(sales):
    days = [{"invoice_date": f"2011-01-0{i} 10:00:00", "quantity": i, "invoice": str(i)} for i in range(1, 8)]
    table = daily.add_rolling(daily.daily_aggregates(sales(*days)), (7,), ("quantity",)).orderBy("date").collect()
    assert all(r["quantity_roll7_mean"] is None for r in table[:6])
    assert table[6]["quantity_roll7_mean"] == 4
    assert table[6]["quantity_roll7_std"] == pytest.approx(math.sqrt(28 / 6))


def test_partial_boundary_days(sales):
    table = daily.flag_partial_days(
        daily.daily_aggregates(
            sales(
                {"invoice_date": "2011-01-01 17:00:00"}, {"invoice_date": "2011-01-02 09:00:00"},
                {"invoice_date": "2011-01-03 12:50:00"},
            )
        )
    )
    assert [r["is_partial_day"] for r in table.orderBy("date").collect()] == [False, False, True]
    assert daily.demand_series(table).count() == 2


CUTOFF = "2011-09-10 00:00:00"


def test_label_boundaries(sales):
    def buys(customer, when):
        return {"customer_id": customer, "invoice_date": when, "invoice": f"{customer}{when}"}

    labels = churn.churn_labels(
        sales(
            buys(1, "2011-09-10 00:00:00"),
            buys(2, "2011-09-01 00:00:00"), buys(2, "2011-09-10 00:00:01"),
            buys(3, "2011-09-01 00:00:00"), buys(3, "2011-12-09 00:00:00"),
            buys(4, "2011-09-01 00:00:00"), buys(4, "2011-12-09 00:00:01"),
            buys(5, "2011-09-11 00:00:00"),
        ),
        CUTOFF,
    )
    assert {r["customer_id"]: r["churned"] for r in labels.collect()} == {1: 1, 2: 0, 3: 0, 4: 1}


def test_zero_tenure_and_single_purchase(sales):
    table = churn.enriched_features(sales({"invoice_date": CUTOFF, "quantity": 2, "unit_price": 5.0}), CUTOFF).first()
    assert table["avg_days_between_purchases"] == 0 and table["monetary_per_day"] == 10
    assert table["recency_ratio"] == 0 and table["frequency_trend"] == table["monetary_trend"] == 1.0
    assert table["is_uk"] == 1


def test_trend_splits_at_the_midpoint(sales):
    dates = ["2011-01-01 00:00:00", "2011-08-01 00:00:00", "2011-08-02 00:00:00", "2011-08-03 00:00:00"]
    table = churn.enriched_features(
        sales(*[{"invoice": str(i), "invoice_date": d, "unit_price": 3.0} for i, d in enumerate(dates)]), CUTOFF
    ).first()
    assert table["frequency_trend"] == 1.5 and table["monetary_trend"] == 9 / 4


def test_features_ignore_rows_after_the_cutoff(sales):
    early = [{"customer_id": i % 3, "invoice": str(i), "invoice_date": f"2011-0{1 + i % 8}-05 10:00:00"} for i in range(20)]
    late = [{"customer_id": 1, "invoice": "x", "invoice_date": "2011-10-01 10:00:00", "quantity": 99}]
    without = churn.enriched_features(sales(*early), CUTOFF).orderBy("customer_id").collect()
    assert churn.enriched_features(sales(*early, *late), CUTOFF).orderBy("customer_id").collect() == without


@pytest.mark.parametrize(
    ("revenues", "tiers"), [((80, 15, 5), ["A", "B", "C"]), ((90, 10), ["B", "C"])]
)
def test_abc_tiers(sales, revenues, tiers):
    lines = [{"stock_code": str(i), "unit_price": float(v)} for i, v in enumerate(revenues)]
    table = inventory.abc_classification(sales(*lines)).orderBy("stock_code").collect()
    assert [r["tier"] for r in table] == tiers
    assert table[-1]["cumulative_share"] == 1.0 and sum(r["revenue_share"] for r in table) == pytest.approx(1)


def test_dense_demand_and_mode_tie(sales):
    rows = [{"invoice_date": "2011-03-01 10:00:00", "quantity": 90, "description": "b"}]
    rows += [
        {"invoice_date": "2011-05-01 10:00:00", "stock_code": "other", "description": d, "invoice": str(i)}
        for i, d in enumerate("baab")
    ]
    table = rows_by(inventory.demand_stats(sales(*rows), quantity_cap_percentile=1.0), "stock_code")
    assert table["85123A"]["daily_demand_mean"] == 1
    assert table["85123A"]["daily_demand_std"] == pytest.approx(math.sqrt(89))
    assert table["other"]["description"] == "a"


def test_first_partial_day_counts_for_price_only(sales):
    table = inventory.demand_stats(
        sales(
            {"invoice_date": "2011-05-01 10:00:00", "stock_code": "last"},
            {"invoice_date": "2011-01-31 12:00:00", "stock_code": "edge", "unit_price": 7.0},
        ),
        quantity_cap_percentile=1.0,
    )
    edge = rows_by(table, "stock_code")["edge"]
    assert edge["daily_demand_mean"] == 0 and edge["avg_unit_price"] == 7


def test_stock_policy(spark):
    row = spark.range(1).select(
        inventory.safety_stock(F.lit(2.0), 7, 0.95).alias("safety"),
        inventory.economic_order_quantity(F.lit(1.0), 20, F.lit(0.2)).alias("eoq"),
        inventory.economic_order_quantity(F.lit(1.0), 20, F.lit(0.0)).alias("free"),
        inventory.reorder_point(F.lit(1.0), 7, F.lit(3.0)).alias("point"),
    ).first()
    assert row["safety"] == pytest.approx(8.7037, abs=1e-4) and row["eoq"] == pytest.approx(270.1851, abs=1e-4)
    assert row["free"] == 0 and row["point"] == 10


def test_reorder_needs_less_than_the_point(spark):
    table = spark.createDataFrame([("a", 5.0, 9.0), ("b", 5.0, 9.0)], "stock_code string, reorder_point double, eoq double")
    stock = spark.createDataFrame([("a", 5.0), ("b", 4.9)], "stock_code string, on_hand double")
    got = rows_by(inventory.reorder_trigger(table, stock), "stock_code")
    assert (got["a"]["should_reorder"], got["a"]["recommended_order_qty"]) == (False, 0.0)
    assert (got["b"]["should_reorder"], got["b"]["recommended_order_qty"]) == (True, 9.0)


def test_cluster_names_get_qualifiers(spark):
    rows = [(i, c, r, f, m) for i, (c, r, f, m) in enumerate(
        [(0, 1, 9, 90.0), (1, 1, 9, 80.0), (2, 50, 1, 5.0), (3, 60, 2, 4.0), (-1, 999, 99, 9999.0)])]
    df = spark.createDataFrame(rows, "customer_id long, cluster int, recency_days int, frequency long, monetary double")
    names = {r["cluster"]: r["segment_name"] for r in segmentation.label_segments(df).collect()}
    assert names == {0: "champions_premium", 1: "champions_core", 2: "lost_premium", 3: "lost_core", -1: "noise"}
