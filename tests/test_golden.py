"""Hand-made mini-tables for the cases the test data does not contain."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martlake import schemas
from martlake.operators import detail, kpis, serving, summary

D = Decimal


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def _orders(spark, rows):
    return spark.createDataFrame(
        [
            (o, c, st, ts(p), None, None, ts(dl), ts(es))
            for (o, c, st, p, dl, es) in rows
        ],
        schemas.ORDERS,
    )


def _customers(spark, rows):
    return spark.createDataFrame(rows, schemas.CUSTOMERS)


def _payments(spark, rows):
    return spark.createDataFrame(rows, schemas.PAYMENTS)


def test_payment_summary_ties_and_nulls(spark):
    pay = _payments(
        spark,
        [
            ("o1", 2, "voucher", 1, D("10.00")),
            ("o1", 1, "boleto", 3, D("10.00")),  # tie on value -> lower sequential
            ("o1", 3, "credit_card", 2, D("5.00")),
            ("o2", 1, "zzz", 1, None),  # NULL value ranks last
            ("o2", 2, "aaa", 1, D("1.00")),
            ("o3", 1, "b", 1, D("2.00")),  # same value and sequential -> type name
            ("o3", 1, "a", 1, D("2.00")),
        ],
    )
    out = {r["order_id"]: r for r in detail.payment_summary(pay).collect()}
    assert out["o1"]["main_payment_type"] == "boleto"
    assert out["o1"]["total_payment_value"] == D("25.00")
    assert out["o1"]["max_payment_installments"] == 3
    assert out["o2"]["main_payment_type"] == "aaa"
    assert out["o3"]["main_payment_type"] == "a"


def test_order_wide_delivery_columns(spark):
    orders = _orders(
        spark,
        [
            # late by one day
            ("a", "c1", "delivered", "2020-01-01 10:00:00", "2020-01-12 09:00:00", "2020-01-11 23:00:00"),
            # same day delivery, on time
            ("b", "c1", "delivered", "2020-01-01 10:00:00", "2020-01-01 23:00:00", "2020-01-05 00:00:00"),
            # not delivered -> NULL flag
            ("c", "c2", "shipped", "2020-01-02 23:00:00", None, "2020-01-05 00:00:00"),
            # delivered, NULL estimate -> 0
            ("d", "c3", "delivered", "2020-01-02 23:00:00", "2020-01-03 01:00:00", None),
            # invalid rows
            (None, "c1", "delivered", "2020-01-02 00:00:00", None, None),
            ("e", "c1", "delivered", None, None, None),
        ],
    )
    cust = _customers(spark, [("c1", "u1", "01234", "x", "SP"), ("c2", "u1", "00001", "y", "RJ")])
    pay = _payments(spark, [("a", 1, "boleto", 1, D("3.50"))])
    ow = {r["order_id"]: r for r in detail.order_wide(orders, cust, pay).collect()}
    assert set(ow) == {"a", "b", "c", "d"}
    assert (ow["a"]["delivery_days"], ow["a"]["is_late_delivery"]) == (11, 1)
    assert (ow["b"]["delivery_days"], ow["b"]["is_late_delivery"]) == (0, 0)
    assert ow["c"]["is_late_delivery"] is None and ow["c"]["delivery_days"] is None
    assert (ow["d"]["delivery_days"], ow["d"]["is_late_delivery"]) == (1, 0)
    assert ow["d"]["customer_unique_id"] is None  # no customer row
    assert ow["b"]["total_payment_value"] is None  # no payment
    assert ow["a"]["customer_zip_code_prefix"] == "01234"  # leading zero kept
    assert ow["a"]["order_purchase_date"] == dt.date(2020, 1, 1)

    kept = detail.order_wide(orders, cust, pay, keep_invalid=True)
    flags = sorted((r["order_id"] or "", r["is_valid"]) for r in kept.collect())
    assert flags == [("", 0), ("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 0)]


def test_null_customer_keys_spread_and_never_match(spark):
    rows = [(f"o{i}", None, "delivered", "2020-01-01 00:00:00", None, None) for i in range(50)]
    rows += [("k", "c1", "delivered", "2020-01-01 00:00:00", None, None)]
    orders = _orders(spark, rows)
    cust = _customers(spark, [("c1", "u1", "1", "x", "SP")])
    ow = detail.order_wide(orders, cust, _payments(spark, []))
    assert ow.count() == 51
    assert ow.filter(F.col("customer_unique_id").isNotNull()).count() == 1


def _daily_fixture(spark):
    orders = _orders(
        spark,
        [
            ("1", "c1", "delivered", "2020-01-01 08:00:00", None, None),
            ("2", "c2", "canceled", "2020-01-01 09:00:00", None, None),
            ("3", "c1", "delivered", "2020-01-03 08:00:00", None, None),  # gap day 01-02
            ("4", "c3", "shipped", "2020-01-03 09:00:00", None, None),
            ("5", "c9", "shipped", "2020-01-04 09:00:00", None, None),  # no customer
            ("6", "c4", "shipped", "2021-01-05 09:00:00", None, None),  # next year
        ],
    )
    cust = _customers(
        spark,
        [
            ("c1", "u1", "1", "x", "SP"),
            ("c2", "u2", "1", "x", "SP"),
            ("c3", "u1", "1", "x", "SP"),  # second id of person u1
            ("c4", "u4", "1", "x", "SP"),
        ],
    )
    pay = _payments(
        spark,
        [
            ("1", 1, "boleto", 1, D("100.00")),
            ("2", 1, "boleto", 1, D("0.01")),
            ("3", 1, "boleto", 1, D("0.00")),  # day with zero GMV
            ("4", 1, "boleto", 1, D("0.00")),
            ("5", 1, "boleto", 1, D("50.00")),
            ("6", 1, "boleto", 1, D("75.00")),
        ],
    )
    return detail.order_wide(orders, cust, pay)


def test_daily_stats_and_new_customers(spark):
    daily = {r["stat_date"].isoformat(): r for r in summary.daily_order_stats(_daily_fixture(spark)).collect()}
    d1 = daily["2020-01-01"]
    assert (d1["total_orders"], d1["delivered_orders"], d1["canceled_orders"]) == (2, 1, 1)
    assert d1["gmv"] == D("100.01")
    assert d1["avg_order_value"] == 50.01  # 50.005 rounds half up
    assert (d1["total_customers"], d1["new_customers"]) == (2, 2)
    d3 = daily["2020-01-03"]
    assert (d3["total_customers"], d3["new_customers"]) == (1, 0)  # u1 twice, not new
    d4 = daily["2020-01-04"]
    assert (d4["total_customers"], d4["new_customers"]) == (0, 0)  # unknown customer


def test_gmv_trend_gaps_zero_and_year_boundary(spark):
    daily = summary.daily_order_stats(_daily_fixture(spark))
    trend = {r["stat_date"].isoformat(): r["gmv_growth_pct"] for r in serving.gmv_trend(daily).collect()}
    assert trend["2020-01-01"] is None  # first row
    assert trend["2020-01-03"] == -100.0  # previous present day is 01-01 (gap skipped)
    assert trend["2020-01-04"] is None  # previous GMV is 0 -> NULLIF
    assert trend["2021-01-05"] == 50.0  # carried across the year bucket


def test_category_stats_and_top_k(spark):
    ow = _daily_fixture(spark)
    items = spark.createDataFrame(
        [
            ("1", 1, "p1", "s", None, D("10.00"), D("1.00")),
            ("1", 2, "p1", "s", None, D("10.01"), D("1.00")),
            ("1", 3, "p2", "s", None, D("5.00"), D("1.00")),
            ("3", 1, "p3", "s", None, D("1.00"), D("1.00")),  # NULL category
            ("4", 1, "p2", "s", None, D("5.00"), D("1.00")),
        ],
        schemas.ORDER_ITEMS,
    )
    products = spark.createDataFrame(
        [("p1", "toys", *[None] * 7), ("p2", "books", *[None] * 7), ("p3", None, *[None] * 7)],
        schemas.PRODUCTS,
    )
    iw = detail.order_item_wide(items, products)
    cats = {(r["stat_month"], r["product_category_name"]): r for r in summary.category_stats(ow, iw).collect()}
    toys = cats[("2020-01", "toys")]
    assert (toys["total_orders"], toys["total_revenue"], toys["avg_item_price"]) == (1, D("20.01"), 10.01)
    assert cats[("2020-01", "books")]["total_orders"] == 2
    assert len(cats) == 2
    top = serving.top_categories(summary.category_stats(ow, iw), k=1).collect()
    assert [(r["rank_no"], r["product_category_name"], r["revenue_pct"]) for r in top] == [
        (1, "toys", 66.68)
    ]


def test_kpis_empty_and_null_rules(spark):
    empty = _daily_fixture(spark).limit(0)
    vals = {r["metric_name"]: r["metric_value"] for r in kpis.order_kpis(empty).collect()}
    assert vals[kpis.LATE_DELIVERY_RATE] == 0.0 and vals[kpis.AVG_DELIVERY_DAYS] == 0.0
    ow = _daily_fixture(spark)
    rr = kpis.repurchase_rate(ow).collect()[0]["metric_value"]
    # groups: u1 (3 orders), u2, u4, NULL group (order 5) -> 1 of 4
    assert rr == 25.0


def test_refresh_metrics_keeps_unknown_names(spark):
    cat = kpis.metric_catalog(spark)
    vals = spark.createDataFrame([("Total GMV", 1.5), ("Something New", 2.0)], "metric_name string, metric_value double")
    out = {r["metric_name"]: r for r in kpis.refresh_metrics(cat, vals).collect()}
    assert out["Total GMV"]["metric_value"] == 1.5 and out["Total GMV"]["metric_unit"] == "BRL"
    assert out["Something New"]["metric_unit"] is None
    assert out["Total Orders"]["metric_value"] is None
    assert len(out) == len(kpis.CATALOG) + 1


def test_sql_form_matches_dataframe_form(spark):
    from martlake.functions.numbers import decimals_to_double
    from martlake.operators.summary_sql import daily_order_stats_sql

    ow = _daily_fixture(spark)
    a = decimals_to_double(summary.daily_order_stats(ow)).collect()
    b = decimals_to_double(daily_order_stats_sql(ow)).collect()
    key = lambda r: r["stat_date"]
    assert sorted(map(tuple, sorted(a, key=key))) == sorted(map(tuple, sorted(b, key=key)))


def test_review_mean_rounds_once(spark):
    """200 orders, three of them with scores 3, 3, 4: the mean of means is
    801 / 200 = 4.005, which is 4.01 (4.0 if each order's mean is rounded)."""
    def scores(i):
        return (3, 3, 4) if i < 3 else (5,) if i < 6 else (4,)

    orders = _orders(spark, [(str(i), "c", "delivered", "2020-01-01 08:00:00", None, None) for i in range(200)])
    items = spark.createDataFrame([(str(i), 1, "p", "s", None, D("1.00"), D("0.00")) for i in range(201)], schemas.ORDER_ITEMS)
    products = spark.createDataFrame([("p", "toys", *[None] * 7)], schemas.PRODUCTS)
    reviews = spark.createDataFrame(
        [(f"{i}-{k}", str(i), s, None, None, None, None) for i in range(200) for k, s in enumerate(scores(i))]
        + [("x", "7", None, None, None, None, None)], schemas.REVIEWS)
    ow = detail.order_wide(orders, _customers(spark, []), _payments(spark, []))
    iw = detail.order_item_wide(items, products)
    for by_month in (True, False):
        row = summary.category_review_scores(ow, iw, reviews, by_month=by_month).collect()[0]
        assert (row["reviewed_orders"], row["avg_review_score"]) == (200, 4.01)
    cats = summary.category_stats(ow, iw, reviews)
    assert cats.collect()[0]["avg_review_score"] == 4.01
    top = serving.top_categories(summary.category_stats(ow, iw), scores=summary.category_review_scores(ow, iw, reviews, by_month=False))
    assert top.collect()[0]["avg_review_score"] == 4.01


def test_daily_stats_with_a_repeated_order(spark):
    orders = _orders(spark, [
        ("1", "c1", "delivered", "2020-01-01 08:00:00", None, None),
        ("1", "c1", "delivered", "2020-01-01 08:00:00", None, None),
        ("2", "c1", "shipped", "2020-01-02 08:00:00", None, None),
        ("3", None, "canceled", "2020-01-02 08:00:00", None, None),
    ])
    ow = detail.order_wide(orders, _customers(spark, [("c1", "u1", "1", "x", "SP")]), _payments(spark, [("1", 1, "b", 1, D("2.00"))]))
    days = {r["stat_date"].day: r for r in summary.daily_order_stats(ow).collect()}
    assert (days[1]["total_orders"], days[1]["delivered_orders"], days[1]["gmv"]) == (1, 2, D("4.00"))
    assert (days[1]["total_customers"], days[1]["new_customers"]) == (1, 1)
    assert (days[2]["total_orders"], days[2]["total_customers"], days[2]["new_customers"]) == (2, 1, 0)


def test_item_totals_and_unknown_customers(spark):
    ow = _daily_fixture(spark)
    assert kpis.repurchase_rate(ow, unknown=False).collect()[0]["metric_value"] == 33.33
    orders = _orders(spark, [("a", "c", "shipped", "2020-01-01 08:00:00", None, None), ("b", "c", "shipped", "2020-01-01 08:00:00", None, None)])
    items = spark.createDataFrame([("a", i, "p", "s", None, D("1.50"), D("0.25")) for i in (1, 2)], schemas.ORDER_ITEMS)
    out = detail.order_wide(orders, _customers(spark, []), _payments(spark, []), items=items, keep_invalid=True)
    got = {r["order_id"]: (r["total_item_price"], r["total_freight_value"], r["item_count"]) for r in out.collect()}
    assert got == {"a": (D("3.00"), D("0.50"), 2), "b": (None, None, 0)}


def test_report_order(spark):
    daily = summary.daily_order_stats(_daily_fixture(spark))
    trend = serving.in_report_order(serving.gmv_trend(daily), "gmv_trend").collect()
    dates = [r["stat_date"] for r in trend]
    assert dates == sorted(dates, reverse=True)


def test_review_mean_with_a_dozen_coprime_review_counts(spark):
    counts = [101, 103, 107, 109, 113, 127, 131, 137, 139, 149, 151, 157, 163, 167, 173, 179, 181, 191, 193, 197]
    orders = _orders(spark, [(str(c), "c", "delivered", "2020-01-01 08:00:00", None, None) for c in counts])
    items = spark.createDataFrame([(str(c), 1, "p", "s", None, D("1.00"), D("0.00")) for c in counts], schemas.ORDER_ITEMS)
    products = spark.createDataFrame([("p", "toys", *[None] * 7)], schemas.PRODUCTS)
    reviews = spark.createDataFrame(
        [(f"{c}-{k}", str(c), 1 + k % 5, None, None, None, None) for c in counts for k in range(c)], schemas.REVIEWS)
    ow = detail.order_wide(orders, _customers(spark, []), _payments(spark, []))
    iw = detail.order_item_wide(items, products)
    for by_month in (True, False):
        row = summary.category_review_scores(ow, iw, reviews, by_month=by_month).collect()[0]
        assert (row["reviewed_orders"], row["avg_review_score"]) == (20, 2.98)
