"""Unit tests on small literal frames (FIXTURES.md section 4) and the semantic traps."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.functions import calendar as C
from riskspark.functions.scalar import clip, concat_strict, label, portable_hash, round_to
from riskspark.operators import windows as W
from riskspark.plans import kpi
from riskspark.plans import queries as Q
from riskspark.plans import scoring as S

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# -- Q7 buckets and the null trap (T8) -------------------------------------------------
def test_delay_edges(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (3,), (4,), (10,), (11,)], "delay_days int")
    got = {r.delay_days: r.delay_category for r in df.select("delay_days", Q.delay_category().alias("delay_category")).collect()}
    assert got == {None: "Critical Delay", 0: "On Time", 1: "Minor Delay", 3: "Minor Delay",
                   4: "Significant Delay", 10: "Significant Delay", 11: "Critical Delay"}


# -- Q13 rank shapes ---------------------------------------------------------------------
def test_rank_ties(spark):
    df = spark.createDataFrame([("a", 90.0), ("b", 90.0), ("c", 80.0)], "supplier_name string, reliability_score double")
    got = rows(Q.rank_dense_rank(df), "supplier_name", "rank_with_gaps", "rank_no_gaps")
    assert got == [("a", 1, 1), ("b", 1, 1), ("c", 3, 2)]


def test_global_rank_matches_plain_window_with_hot_value(spark):
    # a third of the rows share one score
    data = [(i, 50 if i % 3 == 0 else i % 97) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, score int")
    ours = W.global_rank(df, "score", descending=True)
    plain = df.select("id", F.rank().over(Window.orderBy(F.desc("score"))).alias("r"),
                      F.dense_rank().over(Window.orderBy(F.desc("score"))).alias("d"))
    assert rows(ours, "id", "rank", "dense_rank") == rows(plain, "id", "r", "d")


# -- W3 running sum: equals the plain window, last row = grand total -----------------------------
def test_running_sum_matches_window_and_total(spark):
    # one day holds a third of the rows
    data = [(D(2020, 1, 1) if i % 3 == 0 else D(2020, 1, 2) + dt.timedelta(days=i % 50), i, (i * 7) % 11) for i in range(4000)]
    df = spark.createDataFrame(data, "d date, k int, v int")
    ours = W.running_sum(df, "v", ["d", "k"], "run", ["d", W.id_range("k", 300)])
    plain = df.withColumn("run", F.sum("v").over(Window.orderBy("d", "k").rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(ours, "k", "run") == rows(plain, "k", "run")
    total = df.agg(F.sum("v")).first()[0]
    assert ours.agg(F.max("run")).first()[0] == total


def test_running_sum_descending_with_nulls(spark):
    data = [(None, 1), (5, 2), (5, 3), (None, 4), (1, 5), (9, 6)]
    df = spark.createDataFrame(data, "s int, k int")
    ours = W.running_sum(df, F.lit(1), [("s", "desc"), "k"], "pos", [("s", "desc"), W.id_range("k", 2)])
    plain = df.withColumn("pos", F.count(F.lit(1)).over(
        Window.orderBy(F.col("s").desc_nulls_last(), "k").rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(ours, "k", "pos") == rows(plain, "k", "pos")


# -- W6 clamped balance --------------------------------------------------------------------------
def test_stock_clamp(spark):
    df = spark.createDataFrame([(1, 1, -15, 10), (1, 2, 4, 10), (1, 3, -1, 10)],
                               "product_id int, month int, delta int, start int")
    got = rows(W.clamped_balance(df, ["product_id"], ["month"], "delta", "start", "stock"), "month", "stock")
    assert got == [(1, 0), (2, 4), (3, 3)]


def test_clamped_balance_matches_loop(spark):
    import random

    rnd = random.Random(3)
    data = [(p, m, rnd.randint(-60, 40), 100 + p) for p in range(5) for m in range(40)]
    df = spark.createDataFrame(data, "p int, m int, x int, b int")
    got = dict(((r.p, r.m), r.s) for r in W.clamped_balance(df, ["p"], ["m"], "x", "b", "s").collect())
    for p in range(5):
        s = 100 + p
        for m in range(40):
            s = max(0, s + data[p * 40 + m][2])
            assert got[(p, m)] == s
            assert s >= 0


# -- Q8 latest snapshot ties (T9) -------------------------------------------------------------
def test_latest_ties_kept(spark):
    df = spark.createDataFrame([(1, 1, D(2024, 1, 1), 5, 10), (1, 1, D(2024, 2, 1), 3, 10),
                                (1, 1, D(2024, 2, 1), 4, 10), (2, 1, D(2024, 2, 1), 50, 10)],
                               "product_id int, warehouse_id int, snapshot_date date, stock_quantity int, reorder_point int")
    got = rows(Q.low_stock_latest(df), "product_id", "stock_quantity")
    assert got == [(1, 3), (1, 4)]


# -- T1 AVG over INT ---------------------------------------------------------------------------
def test_avg_int(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (2, "x")], "delay_days int, delay_reason string")
    r = Q.delay_by_reason(df).first()
    assert r.avg_delay == pytest.approx(1.666667)
    assert r.avg_delay_int == 1


# -- U4 zero fill / Q14 calendar / U3 recursion guard ----------------------------------------------
def test_sparse_months_zero_filled(spark):
    cal = spark.createDataFrame([(D(2024, 1, 1), D(2024, 4, 1))], "lo date, hi date")
    months = C.month_series(cal, out="month_year")
    hits = spark.createDataFrame([(D(2024, 1, 1), 3), (D(2024, 3, 1), 1)], "month_year date, n int")
    got = rows(C.zero_fill(months, hits, "month_year", ["n"]), "month_year", "n")
    assert got == [(D(2024, 1, 1), 3), (D(2024, 2, 1), 0), (D(2024, 3, 1), 1), (D(2024, 4, 1), 0)]


def test_month_series_reference_span(spark):
    cal = spark.createDataFrame([(D(2022, 1, 1), D(2024, 12, 1))], "lo date, hi date")
    got = [r.month_start for r in Q.month_calendar(cal).collect()]
    assert len(got) == 36 and got[0] == D(2022, 1, 1) and got[-1] == D(2024, 12, 1)


def test_recursion_guard(spark):
    cal = spark.createDataFrame([(D(2000, 1, 1), D(2024, 12, 1))], "lo date, hi date")
    with pytest.raises(Exception, match="recursion"):
        Q.month_calendar(cal, max_steps=100).collect()


# -- T7 / T10 / T11 scalar traps ---------------------------------------------------------------
def test_round_modes(spark):
    r = spark.range(1).select(round_to(F.lit(2.5), 0).alias("sql"), round_to(F.lit(2.5), 0, half_even=True).alias("np")).first()
    assert (r.sql, r.np) == (3.0, 2.0)


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (10.0,), (50.0,), (120.0,)], "x double")
    got = sorted((r.x, r.c) for r in df.select("x", clip("x", 25, 99).alias("c")).collect() if r.x is not None)
    assert got == [(10.0, 25.0), (50.0, 50.0), (120.0, 99.0)]
    assert df.where(F.col("x").isNull()).select(clip("x", 25, 99).alias("c")).first().c is None


def test_string_building_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    out = df.select(concat_strict("x", "y").alias("strict"), label("%s-%s", "x", "y", null_as="?").alias("lenient")).collect()
    assert [(r.strict, r.lenient) for r in out] == [(None, "a-?"), ("ab", "a-b")]


def test_text_equality_is_binary(spark):
    r = spark.sql("SELECT 'Bangladesh' = 'bangladesh' AS bin, "
                  "'Bangladesh' COLLATE UTF8_LCASE = 'bangladesh' AS ci").first()
    assert (r.bin, r.ci) == (False, True)


# -- E4-E6 ordered reason rules --------------------------------------------------------------------
def test_reason_order(spark):
    data = [(0, 90.0, 90.0, 90.0, "None"), (5, 40.0, 60.0, 10.0, "Weather"), (5, 60.0, 60.0, 10.0, "Weather"),
            (5, 70.0, 60.0, 10.0, "Political"), (5, 10.0, 10.0, 60.0, "Port Congestion"),
            (5, 52.0, 10.0, 10.0, "Political"), (5, 10.0, 10.0, 10.0, "Operational")]
    df = spark.createDataFrame(data, "delay_days int, political_risk double, weather_severity double, congestion double, want string")
    for r in df.select("want", S.delay_reason().alias("got")).collect():
        assert r.got == r.want


def test_elevated_and_severity(spark):
    df = spark.createDataFrame([(60.0, 0.0, 0.0), (10.0, 10.0, 10.0)],
                               "political_risk double, weather_severity double, congestion double")
    out = df.select(S.elevated().alias("e"), S.severity_factor().alias("f"), S.expected_delay().alias("x")).collect()
    assert out[0].e and out[0].f == pytest.approx(1.5) and out[0].x == pytest.approx(1.05)
    assert not out[1].e and out[1].f == 0 and out[1].x == pytest.approx(0.048)


def test_signals_follow_the_supplier_and_congestion_the_port(spark):
    sh = spark.createDataFrame([(1, 1, D(1996, 3, 5), 0), (2, 1, D(1996, 3, 5), 0), (None, 9, D(1996, 3, 5), 0)],
                               "po_id long, origin_port_id long, ship_date date, delay_days int")
    po = spark.createDataFrame([(1, 50), (2, 51)], "po_id long, supplier_id long")
    sup = spark.createDataFrame([(50, 4), (51, 8)], "supplier_id long, country_id int")
    ports = spark.createDataFrame([(1, 7, 70.0)], "port_id long, country_id int, avg_congestion_score double")
    pol = spark.createDataFrame([(4, D(1996, 3, 1), 61.0), (7, D(1996, 3, 1), 99.0)], "country_id int, month_year date, risk_score double")
    wx = spark.createDataFrame([(4, D(1996, 3, 9), 12.0), (4, D(1996, 3, 8), 5.0), (7, D(1996, 3, 9), 80.0)],
                               "country_id int, event_date date, severity_score double")
    got = {r.po_id: (r.country_id, r.political_risk, r.weather_severity, r.congestion)
           for r in S.enrich_signals(sh, po, sup, ports, pol, wx).collect()}
    assert got == {1: (4, 61.0, 12.0, 70.0), 2: (8, 30.0, 0.0, 70.0), None: (None, 30.0, 0.0, 30.0)}


# -- K3 revenue at risk ----------------------------------------------------------------------------
def test_revenue_at_risk_null_po(spark):
    sh = spark.createDataFrame([(1, 1, 1, 5.0, D(2020, 1, 1), 5, "Weather"), (None, 2, 1, 5.0, D(2020, 1, 1), 9, "Weather")],
                               "po_id long, line_no int, origin_port_id long, line_price double, ship_date date, delay_days int, delay_reason string")
    po = spark.createDataFrame([(1, 7, 3)], "po_id long, product_id long, quantity int")
    prod = spark.createDataFrame([(7, "widget", 2.5)], "product_id long, product_name string, unit_price double")
    ports = spark.createDataFrame([(1, 0)], "port_id long, country_id int")
    countries = spark.createDataFrame([(0, "X", 10)], "country_id int, country_name string, base_risk_score int")
    summary = Q.shipment_risk_summary(sh, po, prod, ports, countries)
    assert summary.count() == 1
    assert kpi.revenue_at_risk(summary).first().revenue_at_risk == 7.5


# -- portable hash equals DuckDB's -------------------------------------------------------------------
def test_portable_hash_matches_duckdb(spark):
    import duckdb

    got = spark.range(5).select(portable_hash("id", seed=42).alias("h")).collect()
    want = duckdb.sql("SELECT ('0x' || SUBSTR(MD5('42:' || CAST(range AS VARCHAR)), 1, 15))::BIGINT AS h "
                      "FROM range(5) ORDER BY range").fetchall()
    assert [r.h for r in got] == [w[0] for w in want]


def test_hot_day_is_split_and_nulls_keep_their_place(spark):
    data = [(None if i % 11 == 0 else D(2020, 1, 1) if i % 3 == 0 else D(2020, 1, 2) + dt.timedelta(days=i % 40), i, (i * 5) % 13)
            for i in range(5000)]
    df = spark.createDataFrame(data, "d date, k int, v int")
    plain = df.withColumn("run", F.sum("v").over(Window.orderBy("d", "k").rowsBetween(Window.unboundedPreceding, 0)))
    want = rows(plain, "k", "run")
    for segments in (["d"], ["d", W.id_range("k", 500)], [F.year("d"), "d", W.id_range("k", 64)]):
        assert rows(W.running_sum(df, "v", ["d", "k"], "run", segments), "k", "run") == want


def test_top_delays_dataframe_form_equals_sql_over_view(spark):
    from conftest import SF001
    from riskspark.plans import catalog
    from riskspark.plans.registry_core import as_doubles, summary

    d = catalog.domain(spark, SF001)
    via_df = [tuple(r) for r in as_doubles(summary(d)).orderBy(F.desc("delay_days"), *Q.SUMMARY_ORDER).limit(20).collect()]
    via_sql = [tuple(r) for r in catalog.run("o04_top20_delays", spark, SF001).collect()]
    assert via_df == via_sql and len(via_df) == 20


def test_decimal_widening_reference_types(spark):
    """T6: DECIMAL(10,2) price x INT quantity stays exact (Spark types it DECIMAL(21,2))."""
    from decimal import Decimal

    sh = spark.createDataFrame([(1, 1, 1, 5.0, D(2020, 1, 1), 5, "Weather")],
                               "po_id int, line_no int, origin_port_id int, line_price double, ship_date date, "
                               "delay_days int, delay_reason string")
    po = spark.createDataFrame([(1, 7, 2500)], "po_id int, product_id int, quantity int")
    prod = spark.sql("SELECT 7 AS product_id, 'x' AS product_name, CAST(449.99 AS DECIMAL(10,2)) AS unit_price")
    ports = spark.createDataFrame([(1, 0)], "port_id int, country_id int")
    countries = spark.createDataFrame([(0, "X", 10)], "country_id int, country_name string, base_risk_score int")
    summary = Q.shipment_risk_summary(sh, po, prod, ports, countries)
    assert summary.schema["order_value"].dataType.simpleString() == "decimal(21,2)"
    assert summary.first().order_value == Decimal("1124975.00")


def test_dense_position_is_gapless(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(1000)], "g int, k long")
    got = rows(W.dense_position(df, ["g", "k"], ["g", W.id_range("k", 100)], "pos", start=1), "g", "k", "pos")
    assert [p for _, _, p in got] == list(range(1, 1001))


def test_results_do_not_depend_on_segments(spark):
    data = [(D(2020, 1, 1) + dt.timedelta(days=i % 9), i, (i * 11) % 5) for i in range(3000)]
    df = spark.createDataFrame(data, "d date, k int, v int")
    outs = [rows(W.running_sums(df, {"run": "v"}, ["d", "k"], ["d", W.id_range("k", w)]), "k", "run") for w in (7, 100, 10**9)]
    assert outs[0] == outs[1] == outs[2]


@pytest.mark.parametrize("descending", [True, False])
def test_rank_of_scores_in_any_range(spark, descending):
    """Scores within [0, 1), on all scales, in a cluster beside an outlier, negative, infinite, NaN and null."""
    wide = spark.range(3000).select(F.expr("CAST(id % 1000 AS DOUBLE) / 1000 * power(10D, id % 41 - 20) * (CASE WHEN id % 3 = 0 THEN -1 ELSE 1 END)").alias("s"))
    tight = spark.range(2000).select(F.expr("5D + id * 1e-13D").alias("s"))
    odd = spark.sql("SELECT explode(array(CAST('Infinity' AS DOUBLE), CAST('-Infinity' AS DOUBLE), CAST('NaN' AS DOUBLE), 0D, -0D, NULL, NULL, 1e300D)) AS s")
    df = wide.union(tight).union(odd)
    order = F.col("s").desc_nulls_last() if descending else F.col("s").asc_nulls_first()
    w = Window.orderBy(order)
    key = lambda r: tuple(str(x) for x in r)
    want = sorted((tuple(r) for r in df.select("s", F.rank().over(w), F.dense_rank().over(w)).collect()), key=key)
    got = sorted((tuple(r) for r in W.global_rank(df, "s", descending, dense=20).select("s", "rank", "dense_rank").collect()), key=key)
    assert [key(x) for x in got] == [key(x) for x in want]
    for kind in ("int", "decimal(9,2)", "float"):
        typed = spark.range(500).select(((F.col("id") * 37 % 101) - 50).cast(kind).alias("s"))
        w2 = Window.orderBy(F.col("s").desc() if descending else F.col("s"))
        assert sorted(map(tuple, typed.select("s", F.rank().over(w2), F.dense_rank().over(w2)).collect())) == \
            sorted(map(tuple, W.global_rank(typed, "s", descending, dense=5).select("s", "rank", "dense_rank").collect()))


def test_scores_between_0_and_1_give_many_segments(spark):
    hist = spark.range(200_000).select(F.expr("(id * 7919 % 200000) / 200000D").alias("s")).withColumn("_n", F.lit(1))
    sizes = W.radix_pieces(hist, "s", dense=1000).groupBy("_p0", "_p1", "_p2").count().agg(F.count(F.lit(1)), F.max("count")).first()
    assert sizes[0] >= 200 and sizes[1] <= 2000
    close = spark.range(50_000).select(F.expr("1D + id * 1e-15D").alias("s")).distinct().union(spark.sql("SELECT 1e9D")).withColumn("_n", F.lit(1))
    parts = W.radix_pieces(close, "s", dense=100).groupBy("_p0", "_p1", "_p2").count().agg(F.max("count")).first()[0]
    assert parts <= 400


def test_recursive_months_and_their_limit(spark):
    bounds = spark.createDataFrame([(dt.date(2022, 1, 15), dt.date(2024, 12, 1))], "lo date, hi date")
    got = [r.month_start for r in C.month_series_by_recursion(bounds).orderBy("month_start").collect()]
    assert got == [r.month_start for r in C.month_series(bounds).orderBy("month_start").collect()] and len(got) == 36
    with pytest.raises(Exception, match="RECURSION"):
        C.month_series_by_recursion(bounds, max_level=10).collect()
    assert C.month_series_by_recursion(bounds.where("lo > hi")).count() == 0


def test_text_key_ignores_case_and_trailing_blanks_only(spark):
    from riskspark.functions.scalar import text_key

    rows = spark.createDataFrame([("Bangladesh",), ("BANGLADESH  ",), (" Bangladesh",), ("Bangla desh",), (None,)], "n string")
    assert rows.where(text_key("n") == text_key(F.lit("bangladesh"))).count() == 2
    assert rows.where(F.col("n") == "bangladesh").count() == 0
    assert rows.groupBy(text_key("n").alias("k")).count().count() == 4


def test_sql_function_rounds_its_parameter_as_declared(spark):
    spark.createDataFrame([(1, "at", 45), (2, "above", 46)], "country_id int, country_name string, base_risk_score int").createOrReplaceTempView("countries")
    spark.createDataFrame([(1, "s1", 50.0), (2, "s2", 60.0)], "country_id int, supplier_name string, reliability_score double").createOrReplaceTempView("suppliers")
    Q.register_high_risk_function(spark)
    names = lambda t: {r.country_name for r in spark.sql(f"SELECT * FROM high_risk_suppliers({t})").collect()}
    assert names("44.994") == {"at", "above"} and names("44.995") == {"above"} and names("45.005") == {"above"}
