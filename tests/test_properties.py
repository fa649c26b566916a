"""Property tests: the distributed operators equal their plain single-partition definitions."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.operators import windows as W
from riskspark.plans import queries as Q

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.integers(0, 5) | st.none(), st.integers(-20, 20)), min_size=1, max_size=60)


@SETTINGS
@given(data=rows_st, width=st.integers(1, 70))
def test_running_sum_equals_window(spark, data, width):
    df = spark.createDataFrame([(g, i, v) for i, (g, v) in enumerate(data)], "g int, k int, v int")
    ours = W.running_sum(df, "v", ["g", "k"], "run", ["g", W.id_range("k", width)])
    plain = df.withColumn("run", F.sum("v").over(Window.orderBy(F.col("g").asc_nulls_first(), "k")
                                                  .rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted((r.k, r.run) for r in ours.collect()) == sorted((r.k, r.run) for r in plain.collect())
    # the last row in the order carries the grand total
    last = ours.orderBy(F.col("g").desc_nulls_last(), F.desc("k")).first()
    assert last.run == sum(v for _, v in data)


@SETTINGS
@given(scores=st.lists(st.integers(0, 8) | st.none(), min_size=1, max_size=50))
def test_global_rank_equals_window(spark, scores):
    df = spark.createDataFrame(list(enumerate(scores)), "id int, s int")
    ours = W.global_rank(df, "s", descending=True)
    w = Window.orderBy(F.col("s").desc_nulls_last())
    plain = df.select("id", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
    assert sorted((r.id, r["rank"], r.dense_rank) for r in ours.collect()) == \
        sorted((r.id, r.r, r.d) for r in plain.collect())


@SETTINGS
@given(deltas=st.lists(st.integers(-50, 50), min_size=1, max_size=30), start=st.integers(0, 100))
def test_clamped_balance_equals_loop(spark, deltas, start):
    df = spark.createDataFrame([(1, i, d, start) for i, d in enumerate(deltas)], "p int, m int, x int, b int")
    got = [r.s for r in W.clamped_balance(df, ["p"], ["m"], "x", "b", "s").orderBy("m").collect()]
    want, s = [], start
    for d in deltas:
        s = max(0, s + d)
        want.append(s)
    assert got == want


@SETTINGS
@given(delays=st.lists(st.integers(0, 15), min_size=1, max_size=40))
def test_running_delay_last_row_is_total(spark, delays):
    base = dt.date(2000, 1, 1)
    sh = spark.createDataFrame([(base + dt.timedelta(days=i % 7), i, 1, 1, 1, 1.0, d) for i, d in enumerate(delays)],
                               "ship_date date, po_id long, line_no int, product_id long, origin_port_id long, "
                               "line_price double, delay_days int")
    out = Q.running_delay(sh, id_width=4).collect()
    assert [r.running_total_delay_days for r in out] == sorted(r.running_total_delay_days for r in out)
    assert out[-1].running_total_delay_days == sum(delays)


def test_high_risk_sql_table_function(spark):
    from conftest import SF001
    from riskspark.plans import catalog

    d = catalog.domain(spark, SF001)
    d.register_views()
    Q.register_high_risk_function(spark)
    via_sql = spark.sql("SELECT * FROM high_risk_suppliers(45)")
    via_df = Q.high_risk_suppliers(d.suppliers, d.countries, 45)
    assert sorted(map(tuple, via_sql.collect())) == sorted(map(tuple, via_df.collect()))
