"""Ingest, audits, lookups, sampling, conditional update and versioned publish."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators import quality as DQ
from riskspark.operators.lookups import lookup_default, tiered_lookup
from riskspark.operators.sampling import exact_fraction, sample_per_group, weighted_pick
from riskspark.operators.update import current_version, publish, read_current, update_where_in
from riskspark.plans import queries as Q
from riskspark.sources import ingest
from riskspark.sources.schema import BY_NAME, TABLES

D = dt.date


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


# -- S1 / S5 / D5 / T3 / T4 / T5 ----------------------------------------------------------------
def test_dirty_csv_quarantine_and_defaults(spark, tmp_dir):
    path = f"{tmp_dir}/shipments.csv"
    _write(path, "shipment_id,po_id,origin_port_id,destination_warehouse_id,ship_date,expected_arrival_date,"
                 "actual_arrival_date,delay_days,delay_reason\n"
                 '1,10,3,4,2023-06-01,2023-06-20,2023-06-22,2,"Weather"\n'
                 "2,,3,4,2023-06-02,2023-06-20,,,None\n"          # null FK allowed, default delay 0, "None" text
                 "3,11,3,4,2023-13-01,2023-06-20,,1,Political\n"   # month 13
                 '4,12,3,4,2023-06-03,2023-06-20,,1,"Port, Congestion"\n'  # quoted comma
                 "5,13,3.5,4,2023-06-03,2023-06-20,,1,Weather\n")  # bad int
    spec = BY_NAME["shipments"]
    good, bad = ingest.load_table(spark, path, spec)
    g = {r.shipment_id: r for r in good.collect()}
    assert set(g) == {1, 2, 4}
    assert g[2].po_id is None and g[2].delay_days == 0 and g[2].delay_reason == "None"
    assert g[4].delay_reason == "Port, Congestion"
    assert bad.count() == 2
    assert good.count() + bad.count() == 5


def test_staged_float_ints_and_bit_booleans(spark, tmp_dir):
    _write(f"{tmp_dir}/w.csv", "weather_event_id,country_id,port_id,event_date,event_type,severity_score\n"
                               "1,3,7.0,2023-06-01,Storm,45.5\n2,3,,2023-06-02,Flood,12.0\n")
    good, bad = ingest.load_table(spark, f"{tmp_dir}/w.csv", BY_NAME["weather_events"])
    assert sorted((r.weather_event_id, r.port_id) for r in good.collect()) == [(1, 7), (2, None)]
    assert bad.count() == 0
    _write(f"{tmp_dir}/co.csv", "order_id,product_id,warehouse_id,order_date,quantity,fulfilled\n"
                                "1,2,3,2023-01-01,5,1\n2,2,3,2023-01-01,5,0\n3,2,3,2023-01-01,5,\n")
    good, _ = ingest.load_table(spark, f"{tmp_dir}/co.csv", BY_NAME["customer_orders"])
    assert sorted((r.order_id, r.fulfilled) for r in good.collect()) == [(1, True), (2, False), (3, False)]


def test_manifest_is_parent_first():
    seen = set()
    for t in TABLES:
        for _, parent, _ in t.fks:
            assert parent in seen, (t.name, parent)
        seen.add(t.name)
    assert len(TABLES) == 18


def test_catalog_flatten_and_cap(spark):
    cat = spark.sql("SELECT map('Semis', array('MCU', 'PMIC'), 'Power', array('Cell')) AS catalog")
    flat = ingest.flatten_catalog(cat)
    assert [(r.category, r.item) for r in flat.orderBy("category_pos", "item_pos").collect()] == \
        [("Semis", "MCU"), ("Semis", "PMIC"), ("Power", "Cell")]
    items = flat.select("category", F.col("item_pos").alias("item_id"), F.col("item").alias("name"))
    out = ingest.explode_variants(items, "category", "item_id", "name", ["Standard", "Pro", "Compact"], cap=4)
    assert out.count() == 4


# -- D1-D4 / U1 / D6 ---------------------------------------------------------------------------------
def test_bad_keys(spark):
    parent = spark.createDataFrame([(1, 50.0), (1, 60.0), (2, 101.0)], "country_id int, score double")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None)], "supplier_id int, country_id int")
    assert [(r.key_value, r.occurrences) for r in DQ.pk_duplicates(parent, ["country_id"], "c").collect()] == [("1", 2)]
    orphans = DQ.fk_orphans(child, ["country_id"], parent, ["country_id"])
    assert [r.supplier_id for r in orphans.collect()] == [11]
    audit = DQ.domain_audit({"c": parent}, [DQ.Rule("score_0_100", "c", F.col("score").between(0, 100))])
    assert audit.first().violations == 1
    nulls = {r.column_name: r.null_rows for r in DQ.null_audit(child, "s").collect()}
    assert nulls == {"supplier_id": 0, "country_id": 1}


def test_row_counts_and_reconcile(spark):
    a = spark.range(3)
    b = spark.range(5)
    counts = DQ.row_counts({"a": a, "b": b})
    got = {r.table_name: r.row_count for r in counts.collect()}
    assert got == {"a": 3, "b": 5, "TOTAL": 8}
    rec = {r.table_name: r.matches for r in DQ.reconcile(counts, {"a": 3, "b": 4}).collect()}
    assert rec["a"] and not rec["b"]


# -- J6 / J10 ------------------------------------------------------------------------------------------
def test_lookup_strict_raises(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    table = spark.createDataFrame([(1, 5.0)], "k int, v double")
    assert sorted(r.out for r in lookup_default(df, table, {"k": "k"}, "v", "out", 30.0).collect()) == [5.0, 30.0]
    with pytest.raises(Exception, match="lookup key missing"):
        lookup_default(df, table, {"k": "k"}, "v", "out", strict=True).collect()


def test_tier_any(spark):
    ents = spark.createDataFrame([(1, 1, "A"), (2, 2, "B"), (3, 9, "Z")], "eid int, country_id int, region string")
    ports = spark.createDataFrame([(100, 1, "A"), (200, 3, "B")], "port_id int, country_id int, region string")
    res = tiered_lookup(ents, "eid", ports, "port_id", [("country", "country_id"), ("region", "region"), ("any", "")],
                        "port")
    got = {r.eid: (r.port, r.tier) for r in res.collect()}
    assert got[1] == (100, "country") and got[2] == (200, "region") and got[3][1] == "any"
    assert got[3][0] in (100, 200)


# -- G1-G4 ----------------------------------------------------------------------------------------------
def test_sampling_exact_and_reproducible(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 7)
    a = exact_fraction(df, 0.04, ["id"])
    b = exact_fraction(df.repartition(13), 0.04, ["id"])
    assert a.count() == 200
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())
    per = sample_per_group(df, ["g"], ["id"], 2)
    assert per.count() == 14 and per.groupBy("g").count().where("count != 2").count() == 0


def test_weighted_pick_shares(spark):
    weights = spark.createDataFrame([("x", 5), ("y", 3), ("z", 1), ("w", 1)], "cat string, weight int")
    picks = weighted_pick(spark.range(20000), "id", weights, "cat", "weight")
    share = {r.cat: r["count"] / 20000 for r in picks.groupBy("cat").count().collect()}
    assert picks.count() == 20000
    assert share["x"] == pytest.approx(0.5, abs=0.02) and share["z"] == pytest.approx(0.1, abs=0.02)


def test_weighted_pick_zero_and_fractional_weights(spark):
    weights = spark.createDataFrame([("a", 0.0), ("b", 0.75), ("c", 0.25), ("d", None)], "cat string, weight double")
    picks = weighted_pick(spark.range(4000), "id", weights, "cat", "weight")
    share = {r.cat: r["count"] / 4000 for r in picks.groupBy("cat").count().collect()}
    assert set(share) == {"b", "c"} and share["b"] == pytest.approx(0.75, abs=0.03) and picks.count() == 4000


def test_lookup_with_repeated_keys_keeps_rows(spark):
    table = spark.createDataFrame([(1, 5.0), (1, 7.0)], "k int, v double")
    got = lookup_default(spark.createDataFrame([(1,), (2,)], "k int"), table, {"k": "k"}, "v", "out", 30.0).collect()
    assert sorted((r.k, r.out) for r in got) == [(1, 7.0), (2, 30.0)]


# -- S1 / S2: what was written comes back ---------------------------------------------------------------
def test_csv_returns_what_it_was_given(spark):
    at = dt.datetime(2024, 2, 29, 1, 2, 3, 456789)
    data = [(1, 'say "hi", ok', at), (2, "line1\nline2\r\nline3", at), (3, " pad ", at), (4, "", at), (5, None, None), (6, "None", at),
            (7, 'a\\b\\"c', at), (8, "tab\tcomma,", at), (9, '"', at), (10, "é\u2028x", at)]
    df = spark.createDataFrame(data, "id int, text string, at timestamp")
    assert sorted(map(tuple, ingest.csv_roundtrip(df).collect())) == sorted(map(tuple, df.collect()))


def test_overflow_is_quarantined_and_headers_are_checked(spark, tmp_dir):
    head = "weather_event_id,country_id,port_id,event_date,event_type,severity_score\n"
    _write(f"{tmp_dir}/w.csv", head + "1,3,30000000000.0,2023-06-01,Storm,45.5\n2,3,7.0,2023-06-01,Storm,45.5\n")
    good, bad = ingest.load_table(spark, f"{tmp_dir}/w.csv", BY_NAME["weather_events"])
    assert [r.weather_event_id for r in good.collect()] == [2] and bad.count() == 1
    _write(f"{tmp_dir}/x.csv", head.replace("country_id,port_id", "port_id,country_id") + "1,3,7.0,2023-06-01,Storm,45.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest.load_table(spark, f"{tmp_dir}/x.csv", BY_NAME["weather_events"])[0].collect()


def test_clean_and_all_bad_loads(spark, tmp_dir):
    head = "country_id,country_name,region,currency_code,base_risk_score\n"
    for name, line, n in (("clean", "1,China,East Asia,CNY,42\n", (1, 0)), ("bad", "1,,East Asia,CNY,42\n", (0, 1))):
        _write(f"{tmp_dir}/{name}/countries.csv", head + line)
        out = f"{tmp_dir}/{name}-out"
        good = ingest.load_all(spark, f"{tmp_dir}/{name}", out, tables=[BY_NAME["countries"]])["countries"]
        assert (good.count(), ingest.quarantined(spark, out, "countries").count()) == n
        assert good.columns == [c for c, _ in BY_NAME["countries"].columns]


# -- M1 / M2 / Q18 layout -------------------------------------------------------------------------------
def test_update_touches_exactly_semi_joined_keys(spark):
    s = spark.createDataFrame([(1, 9, 70.0), (2, 9, 50.0), (3, 4, 80.0)], "supplier_id int, country_id int, reliability_score double")
    keys = s.where("country_id = 9").union(s.where("country_id = 9"))  # duplicates must not multiply rows
    out = update_where_in(s, keys, ["supplier_id"], {"reliability_score": F.col("reliability_score") - 5})
    assert sorted((r.supplier_id, r.reliability_score) for r in out.collect()) == [(1, 65.0), (2, 45.0), (3, 80.0)]
    assert out.columns == s.columns


def test_scalar_subquery_too_many_rows(spark):
    countries = spark.createDataFrame([(1, "X"), (2, "X")], "country_id int, country_name string")
    s = spark.createDataFrame([(1,)], "country_id int")
    with pytest.raises(Exception):
        s.where(F.col("country_id") == Q.country_id_of(countries, "X")).collect()


def test_publish_rollback(spark, tmp_dir):
    path = f"{tmp_dir}/suppliers"
    v1 = spark.createDataFrame([(1, 70.0)], "supplier_id int, reliability_score double")
    assert publish(v1, path) == "v=000001"
    v2 = v1.withColumn("reliability_score", F.col("reliability_score") + 50)

    def in_range(df):
        if df.where("reliability_score > 100").count():
            raise ValueError("score out of range")

    with pytest.raises(ValueError):
        publish(v2, path, checks=[in_range])
    assert current_version(spark, path) == "v=000001"
    assert read_current(spark, path).first().reliability_score == 70.0
    assert publish(v1.withColumn("reliability_score", F.lit(65.0)), path, checks=[in_range]) == "v=000003"
    assert read_current(spark, path).first().reliability_score == 65.0


def test_a_failure_at_any_step_of_publish_keeps_the_old_version(spark, tmp_dir, monkeypatch):
    from riskspark.operators import update

    path = f"{tmp_dir}/t"
    one, two = (spark.createDataFrame([(i,)], "x int") for i in (1, 2))
    publish(one, path)
    broken = two.select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception):
        publish(broken, path)                                   # while rows are written

    def fail(*_):
        raise OSError("lost")

    with pytest.raises(OSError):
        publish(two, path, checks=[fail])                       # in a check
    monkeypatch.setattr(update, "_commit", fail)
    with pytest.raises(OSError):
        publish(two, path)                                      # between the check and the marker
    assert read_current(spark, path).first().x == 1
    monkeypatch.undo()
    publish(two, path)
    assert read_current(spark, path).first().x == 2


def test_date_range_prunes_partitions(spark, tmp_dir):
    sh = spark.createDataFrame([(i, 1, D(2023, 1 + i % 12, 1 + i % 28), i % 5) for i in range(200)],
                               "po_id long, line_no int, ship_date date, delay_days int")
    ingest.write_shipments(sh, f"{tmp_dir}/shipments")
    laid_out = spark.read.parquet(f"{tmp_dir}/shipments")
    q = Q.shipments_between(laid_out, "2023-06-01", "2023-09-01")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ship_month" in plan
    want = sh.where(F.col("ship_date").between(D(2023, 6, 1), D(2023, 9, 1))).count()
    assert q.count() == want


def test_incremental_ingest_stream(spark, tmp_dir):
    from riskspark.sources.schema import BY_NAME
    from riskspark.streaming import ingest_stream

    land = f"{tmp_dir}/landing"
    header = ("shipment_id,po_id,origin_port_id,destination_warehouse_id,ship_date,expected_arrival_date,"
              "actual_arrival_date,delay_days,delay_reason\n")
    _write(f"{land}/a.csv", header + "1,10,3,4,2023-06-01,2023-06-20,,2,Weather\n2,11,3,4,2023-07-01,,,,None\n")
    _write(f"{land}/b.csv", header + "3,12,3,4,2023-13-01,,,1,Political\n")
    q = ingest_stream(spark, land, BY_NAME["shipments"], f"{tmp_dir}/out", f"{tmp_dir}/bad", f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    good = spark.read.parquet(f"{tmp_dir}/out")
    assert sorted((r.shipment_id, r.delay_days) for r in good.collect()) == [(1, 2), (2, 0)]
    assert spark.read.parquet(f"{tmp_dir}/bad").count() == 1


def test_load_all_writes_typed_parquet(spark, tmp_dir):
    from riskspark.sources.schema import BY_NAME

    csv = f"{tmp_dir}/csv"
    _write(f"{csv}/countries.csv", "country_id,country_name,region,currency_code,base_risk_score\n"
                                   "1,China,East Asia,CNY,42\n2,Taiwan,East Asia,TWD,48.5\n3,,Europe,EUR,10\n")
    _write(f"{csv}/shipments.csv", "shipment_id,po_id,origin_port_id,destination_warehouse_id,ship_date,"
                                   "expected_arrival_date,actual_arrival_date,delay_days,delay_reason\n"
                                   "1,10,3,4,2023-06-01,2023-06-20,,2,Weather\n"
                                   "2,11,3,4,2023-07-15,2023-07-30,,,None\n")
    out = f"{tmp_dir}/out"
    loaded = ingest.load_all(spark, csv, out, tables=[BY_NAME["countries"], BY_NAME["shipments"]])
    c = {r.country_id: r.base_risk_score for r in loaded["countries"].collect()}
    assert set(c) == {1, 2} and float(c[2]) == 48.5                  # NOT NULL name missing -> quarantined
    assert ingest.quarantined(spark, out, "countries").count() == 1
    parts = sorted(p for p in os.listdir(f"{out}/shipments/_bad=false") if p.startswith("ship_month="))
    assert parts == ["ship_month=2023-06-01", "ship_month=2023-07-01"]
    assert sorted((r.shipment_id, r.delay_days) for r in loaded["shipments"].collect()) == [(1, 2), (2, 0)]


def test_dynamic_sort_allow_list(spark):
    from conftest import SF001
    from riskspark.plans import catalog

    catalog.domain(spark, SF001).suppliers.createOrReplaceTempView("suppliers")
    out = Q.suppliers_sorted_by(spark, "supplier_name")
    assert out.columns[0] == "supplier_name"
    names = [r[0] for r in out.collect()]
    assert names == sorted(names, reverse=True)
    with pytest.raises(ValueError):
        Q.suppliers_sorted_by(spark, "reliability_score DESC; DROP TABLE suppliers")


def test_fk_audit_two_keys_one_child(spark):
    countries = spark.createDataFrame([(1,), (2,), (2,)], "country_id int")          # duplicate parent key
    ports = spark.createDataFrame([(10,), (11,)], "port_id int")
    ships = spark.createDataFrame([(1, 10), (3, 10), (None, 12), (2, None), (2, 11)], "country_id int, port_id int")
    fks = [DQ.ForeignKey("ships", ("country_id",), "countries", ("country_id",)),
           DQ.ForeignKey("ships", ("port_id",), "ports", ("port_id",))]
    got = {r.fk_columns: r.orphan_rows for r in DQ.fk_audit({"ships": ships, "countries": countries, "ports": ports},
                                                            fks).collect()}
    assert got == {"country_id": 1, "port_id": 1}


def test_scratch_output_goes_under_the_checkpoint_dir(spark):
    from riskspark.session import ensure_checkpoint_dir, scratch_path

    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(base.rstrip("/") + "/riskspark-scratch/x-")


# -- audits over views of shared sources -----------------------------------------------------------
def test_view_audits_equal_table_audits(spark):
    from riskspark.operators.quality import View

    big = 10_000_001
    lines = spark.createDataFrame(
        [(1, big, 3, "R"), (1, big, 3, "A"), (2, 1, big + 2, "R"), (2, 1, big + 2, None), (3, None, 4, "R"), (4, 9, 4, "N")],
        "line long, part long, supp long, flag string")
    parts = spark.createDataFrame([(big, "a"), (1, None), (1, "c")], "part_id long, part_name string")
    sources = {"lines": lines, "parts": parts}
    c = F.col
    views = [View("parts", "parts", {"part_id": c("part_id"), "part_name": c("part_name")}),
             View("lines", "lines", {"line_id": c("line"), "part_id": c("part")}),
             View("returns", "lines", {"return_id": c("line"), "line_id": c("line")}, c("flag") == "R"),
             View("pairs", "lines", {"part_id": c("part"), "supp_id": c("supp")}, distinct=True,
                  derived=lambda of: {"twice": of["part_id"] * 2})]
    keys = {"parts": ["part_id"], "lines": ["line_id"], "returns": ["return_id"], "pairs": ["part_id", "supp_id"]}
    tables = {v.name: v.frame(sources) for v in views}
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    from functools import reduce as fold

    union = lambda parts: rows(fold(lambda a, b: a.unionByName(b), parts))
    assert rows(DQ.view_row_counts(sources, views)) == rows(DQ.row_counts(tables))
    assert dict(rows(DQ.view_row_counts(sources, views)))["pairs"] == 4
    assert rows(DQ.view_pk_duplicates(sources, views, keys)) == union([DQ.pk_duplicates(tables[t], k, t) for t, k in keys.items()])
    required = {"parts": ["part_name"], "lines": ["part_id"], "returns": ["line_id"], "pairs": ["part_id", "supp_id", "twice"]}
    assert rows(DQ.view_null_audit(sources, views, required)) == union([DQ.null_audit(tables[t], t, cs) for t, cs in required.items()])
    fks = [DQ.ForeignKey("lines", ("part_id",), "parts", ("part_id",)), DQ.ForeignKey("pairs", ("part_id",), "parts", ("part_id",)),
           DQ.ForeignKey("returns", ("line_id",), "lines", ("line_id",))]
    assert rows(DQ.view_fk_audit(sources, views, fks)) == rows(DQ.fk_audit(tables, fks))


def test_pairs_of_large_ids_are_not_confused(spark):
    """With an id of first * 10,000,000 + second these two pairs would be one."""
    pairs = spark.createDataFrame([(1, 10_000_001), (2, 1)], "product_id long, supplier_id long")
    assert DQ.pk_duplicates(pairs, ["product_id", "supplier_id"], "p").count() == 0


def test_audits_read_lineitem_few_times(spark):
    """The lines once for plain and once for distinct tables, the orders, the fuel prices, and the month bounds."""
    import __spark_entry__ as E
    from conftest import SF01

    for key in ("u01_row_counts", "d01_pk_duplicates", "d02_fk_orphans", "d03_null_audit", "d06_reconcile"):
        physical = E.queries()[key](spark, SF01)._jdf.queryExecution().executedPlan().toString()
        assert sum("FileScan" in x and "lineitem.parquet" in x for x in physical.splitlines()) <= 6, (key, physical)


def test_null_audit_covers_declared_keys_and_columns_that_queries_read(spark, tmp_dir):
    import __spark_entry__ as E
    from conftest import SF001

    got = {(r.table_name, r.column_name) for r in E.queries()["d03_null_audit"](spark, SF001).collect()}
    assert got >= {(t.name, c) for t in ingest.TABLES for c in (*t.pk, *t.not_null)}
    assert got >= {("shipments", c) for c in ("po_id", "line_no", "product_id", "origin_port_id", "line_price", "ship_date", "delay_days", "delay_reason")}
    assert got >= {("purchase_orders", c) for c in ("po_id", "supplier_id", "product_id", "order_date", "quantity", "status")}


def test_null_audit_shuffles_keys_and_nulls_alone(spark):
    """Of the lines only the order key and the return flag go through the join with the orders; values would be shuffled in full."""
    from conftest import SF001

    from riskspark.sources.bindings import Domain
    from riskspark.sources.model import model_views, null_views

    d = Domain(spark, SF001)
    lean, full = null_views(d)[0]["lines"], model_views(d)[0]["lines"]
    for c in ("l_suppkey", "l_partkey", "line_id", "l_quantity", "l_extendedprice", "ship_date", "order_date", "o_custkey"):
        assert lean.select(c).distinct().count() == 1 < full.select(c).distinct().count(), c
    assert lean.count() == full.count()


def test_null_audit_finds_nulls_of_lines_and_of_their_orders(spark, tmp_dir):
    """Distinct pairs with a null from the line, from its order, or both; lines and orders repeat."""
    from conftest import SF001

    import __spark_entry__ as E

    for t in ("region", "nation", "customer", "supplier", "part", "events"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{tmp_dir}/{t}.parquet")
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    o = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey"))).withColumn("o_orderdate", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")))
    o.write.parquet(f"{tmp_dir}/orders.parquet")
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    for c, m in (("l_orderkey", 97), ("l_suppkey", 11), ("l_partkey", 13), ("l_quantity", 17)):
        li = li.withColumn(c, F.when(F.xxhash64("l_extendedprice", F.lit(c)) % m != 0, F.col(c)))
    li.union(li.limit(50)).write.parquet(f"{tmp_dir}/lineitem.parquet")
    got = {(r.table_name, r.column_name): r.null_rows for r in E.queries()["d03_null_audit"](spark, tmp_dir).collect()}
    li, o = spark.read.parquet(f"{tmp_dir}/lineitem.parquet"), spark.read.parquet(f"{tmp_dir}/orders.parquet")
    sold = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    pairs = sold.select("o_custkey", "l_suppkey").distinct()
    assert got["factory_suppliers", "factory_id"] == pairs.where("o_custkey IS NULL").count() > 0
    assert got["factory_suppliers", "factory_supplier_id"] == pairs.where("o_custkey IS NULL OR l_suppkey IS NULL").count()
    assert got["product_factories", "product_id"] == sold.select("o_custkey", "l_partkey").distinct().where("l_partkey IS NULL").count() > 0
    assert got["supplier_products", "supplier_id"] == li.select("l_suppkey", "l_partkey").distinct().where("l_suppkey IS NULL").count() > 0
    assert got["customer_orders", "order_date"] == sold.where("o_orderdate IS NULL").count() > 0
    assert got["shipments", "po_id"] == li.where("l_orderkey IS NULL").count() > 0
    assert got["purchase_orders", "quantity"] == li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q")).join(o, F.col("l_orderkey") == F.col("o_orderkey")).where("q IS NULL").count()


def test_fk_audit_tells_apart_only_pairs_with_an_orphan(spark, tmp_dir):
    """Orphans of distinct pairs, of repeated lines and of null keys; without orphans the result's plan reads no table of the model."""
    views = [DQ.View("supps", "supps", {"s": F.col("s")}), DQ.View("parts", "parts", {"p": F.col("p")}),
             DQ.View("lines", "li", {"line": F.col("line"), "p": F.col("p")}), DQ.View("stock", "li", {"p": F.col("p")}, F.col("line") > 1),
             DQ.View("pairs", "li", {"s": F.col("s"), "p": F.col("p")}, distinct=True)]
    fks = [DQ.ForeignKey("lines", ("p",), "parts", ("p",)), DQ.ForeignKey("stock", ("p",), "parts", ("p",)),
           DQ.ForeignKey("pairs", ("s",), "supps", ("s",)), DQ.ForeignKey("pairs", ("p",), "parts", ("p",))]
    rows = [(1, 1, 9), (2, 1, 9), (3, 2, 9), (4, 7, None), (5, 7, 1), (6, None, 9), (7, None, None), (8, 1, 1), (8, 1, 1), (None, 7, 1)]
    sources = {"supps": spark.createDataFrame([(1,), (2,), (2,)], "s int"), "parts": spark.createDataFrame([(1,), (None,)], "p long")}
    for some in (rows, [r for r in rows if r[1] in (1, 2, None) and r[2] in (1, None)]):
        spark.createDataFrame(some, "line long, s int, p long").write.mode("overwrite").parquet(f"{tmp_dir}/li{len(some)}")
        sources["li"] = spark.read.parquet(f"{tmp_dir}/li{len(some)}")
        got = DQ.view_fk_audit(sources, views, fks)
        want = DQ.fk_audit({v.name: v.frame(sources) for v in views}, fks)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        if len(some) < len(rows):
            assert f"li{len(some)}" not in got._jdf.queryExecution().executedPlan().toString()


def test_key_audit_deals_rows_to_more_tasks_as_they_grow(spark, monkeypatch):
    """With 500 lines a task, the 6,000 lines of sf0.001 go to 12 or 13 tasks, and the duplicates stay the same."""
    from conftest import SF001

    import __spark_entry__ as E
    from riskspark.sources import model

    want = sorted(map(tuple, E.queries()["d01_pk_duplicates"](spark, SF001).collect()))
    monkeypatch.setattr(model, "ROWS_A_TASK", 500)
    tasks = -(-spark.read.parquet(f"{SF001}/lineitem.parquet").count() // 500)
    got = E.queries()["d01_pk_duplicates"](spark, SF001)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert tasks > 8 and plan.count(f", {tasks})") >= 4
    assert sorted(map(tuple, got.collect())) == want


# -- G4: alias table -------------------------------------------------------------------------------
def _parts(table, n):
    """The part of the whole that each category gets from its own cell and from others."""
    got = {}
    for r in table.collect():
        got[r.c] = got.get(r.c, 0.0) + r.share / n
        if r.share < 1:
            got[r.other] = got.get(r.other, 0.0) + (1 - r.share) / n
    return got


@pytest.mark.parametrize("kind", ["equal", "one", "steep", "fractions", "random"])
def test_alias_table_gives_every_category_its_part(spark, kind):
    import random

    from riskspark.operators.sampling import alias_table

    rnd = random.Random(3)
    w = {"equal": [2.0] * 40, "one": [5.0], "steep": [2.0 ** i for i in range(40)], "fractions": [0.1, 0.2, 0.3, 0.05, 0.35],
         "random": [rnd.randint(1, 1000) for _ in range(300)]}[kind]
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(w)] + [(900, 0.0), (901, None)], "c int, w double")
    table = alias_table(df, "c", "w", "c")
    assert sorted(r.cell for r in table.collect()) == list(range(len(w)))
    got = _parts(table, len(w))
    assert set(got) == set(range(len(w)))
    assert all(abs(got[i] - x / sum(w)) < 1e-9 for i, x in enumerate(w))


def test_weighted_pick_of_many_categories_is_an_equi_join(spark):
    """A million categories: no cross or nested-loop join, no window over all of them, everyone gets one category."""
    cats = spark.range(1_000_000).select(F.col("id").alias("c"), (F.col("id") % 7 + 1).alias("w"))
    picks = weighted_pick(spark.range(20_000).withColumnRenamed("id", "e"), "e", cats, "c", "w")
    plan = picks._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = picks.groupBy((F.col("c") % 7).alias("k")).count().collect()
    assert sum(r["count"] for r in got) == 20_000
    assert all(abs(r["count"] / 20_000 - (r.k + 1) / 28) < 0.02 for r in got)


# -- P6 / O6 ---------------------------------------------------------------------------------------
def test_month_layout_key_prunes_partitions(spark):
    import __spark_entry__ as E
    from conftest import SF01

    df = E.queries()["p06_month_layout"](spark, SF01)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ship_month" in plan
    assert df.count() > 0
    scan = next(x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "ship_month" in scan.split("PartitionFilters")[1].split("]")[0]


@pytest.mark.parametrize("cap", [None, 0, 7, 1000])
def test_capped_catalog_equals_numbering_all(spark, cap):
    items = spark.createDataFrame([("hot" if i % 3 else f"c{i % 5}", i * 70_000, f"n{i}") for i in range(60)], "category string, id long, name string")
    out = ingest.explode_variants(items, "category", "id", "name", ["a", "b"], cap=cap)
    want = sorted((c, i, v) for c, i, _ in map(tuple, items.collect()) for v in range(2))[:cap]
    got = [(r.category, r.id, "ab".index(r.variant)) for r in out.orderBy("catalog_id").collect()]
    assert got == want and [r.catalog_id for r in out.orderBy("catalog_id").collect()] == list(range(1, len(want) + 1))


# -- S1: quoted records over many tasks --------------------------------------------------------------
@pytest.mark.parametrize("block", [64, 150, 1000, 1 << 27])
def test_one_quoted_file_is_read_by_many_tasks(spark, tmp_dir, block):
    import csv
    import random

    rnd = random.Random(block)
    pieces = ["a", " ", '"', ",", "\n", "\n\n", "é", "x" * 30, "\r", ""]
    rows = [(i, "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12))), rnd.choice(["", "t"])) for i in range(120)]
    rows += [(500, "\n" * 400, "lines"), (501, '"' * 333, "quotes"), (502, "y" * 700, "long")]
    path = f"{tmp_dir}/one.csv"
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_NONNUMERIC)
        out.writerow(["id", "text", "more"])
        out.writerows(rows)
    spec = ingest.TableSpec("one", (("id", T.IntegerType()), ("text", T.StringType()), ("more", T.StringType())), ("id",))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        good, bad = ingest.load_table(spark, path, spec)
        lines = spark.read.option("lineSep", "\n").text(path)
        if block < 1000:
            assert lines.rdd.getNumPartitions() > 5
        assert bad.count() == 0
        assert sorted(map(tuple, good.collect())) == sorted(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_files_without_line_ends_in_fields_are_read_by_lines_in_the_jvm(spark, tmp_dir):
    spec = ingest.TableSpec("o", (("id", T.IntegerType()), ("text", T.StringType())), ("id",))
    plain = 'id,text\n1,fine\n\n2,"a, ""b"""\n3,""\n4,\n5,  \nx,bad\n'
    _write(f"{tmp_dir}/plain.csv", plain)
    _write(f"{tmp_dir}/open.csv", plain + '6,"two\nlines"\n')
    by_lines, by_records = (ingest.read_staged(spark, f"{tmp_dir}/{f}.csv", spec) for f in ("plain", "open"))
    assert "MapInArrow" not in by_lines._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in by_records._jdf.queryExecution().executedPlan().toString()
    rows = lambda f: [sorted(map(str, part.collect())) for part in ingest.load_table(spark, f"{tmp_dir}/{f}.csv", spec)]
    (good, bad), (more, same) = rows("plain"), rows("open")
    assert bad == same and len(bad) == 1 and len(good) == 5 and sorted([*good, "Row(id=6, text='two\\nlines')"]) == more
    _write(f"{tmp_dir}/one.csv", "text\n  \nb\n")
    one = ingest.TableSpec("one", (("text", T.StringType()),), ())
    assert sorted(r.text for r in ingest.load_table(spark, f"{tmp_dir}/one.csv", one)[0].collect()) == ["  ", "b"]
    _write(f"{tmp_dir}/cased.csv", "ID,text\n1,a\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest.load_table(spark, f"{tmp_dir}/cased.csv", spec)[0].collect()


def test_open_quote_at_the_end_is_one_bad_or_whole_record(spark, tmp_dir):
    _write(f"{tmp_dir}/o.csv", 'id,text\n1,fine\n2,"open\n3,lost\n')
    spec = ingest.TableSpec("o", (("id", T.IntegerType()), ("text", T.StringType())), ("id",))
    good, bad = ingest.load_table(spark, f"{tmp_dir}/o.csv", spec)
    assert good.count() + bad.count() == 2 and (1, "fine") in set(map(tuple, good.collect()))
    _write(f"{tmp_dir}/e.csv", "id,text\n")
    assert ingest.load_table(spark, f"{tmp_dir}/e.csv", spec)[0].count() == 0
