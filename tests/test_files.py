import json
import os

import pytest
from pyspark.sql import functions as F

from ordermill.plans import raw_to_silver, run_daily_sales, silver_to_gold
from ordermill.sinks import (
    upsert_partitions, write_current, write_one_file_each, write_partitions, write_quarantine, write_snapshot,
)
from ordermill.sources import calendar, ingest_path, read_csv, read_orders_csv, read_raw_orders, read_table, register_views
from ordermill.workspace import shared_folder, staged, staging
from tests.conftest import tuples

DAY = "2025-09-25"


def _order(order_id, customer_id, date, *products):
    return {"order_id": order_id, "customer_id": customer_id, "purchase_date": date,
            "products": [dict(zip(("product_id", "name", "quantity", "price"), p)) for p in products]}


ORDERS = [
    _order("o1", "c1", " 2023-01-01", ("p1", "A", "2,00", "10,99"), ("p2", " B", "1", " 5.99 ")),
    _order("o2", "c2", "2023-01-02 ", ("p1", "A", "3,00", "10,99"), ("p3", "C", " 2", "7.99")),
    _order("o3", "c1", "2023-01-02", ("p1", "A", "one", "10,99"), ("p1", "A", "1", "10,99"), ("p4", "D", "1", "1,234.50")),
    _order("o4", "c1", "sometime", ("p1", "A", "1", "10,99")),
]


def _write(root, orders, day=DAY, lines=False):
    folder = root / "raw" / f"ingest_date={day}"
    folder.mkdir(parents=True)
    text = "\n".join(json.dumps(o) for o in orders) if lines else json.dumps(orders, indent=1)
    (folder / "orders.json").write_text(text)
    return str(root / "raw")


def test_json_array_and_json_lines(spark, tmp_path):
    array = read_raw_orders(spark, ingest_path(_write(tmp_path / "a", ORDERS), DAY))
    lines = read_raw_orders(spark, ingest_path(_write(tmp_path / "b", ORDERS, lines=True), DAY), multiline=False)
    inferred = read_raw_orders(spark, ingest_path(str(tmp_path / "a" / "raw"), DAY), schema=None)
    assert array.count() == lines.count() == 4
    assert "ingest_date" not in array.columns and set(inferred.columns) == {"order_id", "customer_id", "purchase_date", "products"}
    assert tuples(array.select("order_id", F.size("products"))) == tuples(lines.select("order_id", F.size("products")))


@pytest.mark.parametrize("lines", [False, True])
def test_raw_to_silver(spark, tmp_path, lines):
    raw, silver = _write(tmp_path, ORDERS, lines=lines), str(tmp_path / "silver")
    counts = raw_to_silver(spark, raw, silver, DAY, multiline=not lines)
    assert (counts.raw_orders, counts.corrupt_records, counts.lines, counts.quarantined, counts.silver_lines) == (4, 0, 8, 2, 5)
    assert [str(day) for day in counts.purchase_dates] == ["2023-01-01", "2023-01-02"]
    table = read_table(spark, f"{silver}/order_lines")
    assert tuples(table.select("order_id", "product_id", "quantity", F.col("line_amount").cast("double"),
                               F.col("customer_total_revenue").cast("double"), F.col("purchase_date").cast("string"))) == [
        # The undated o4 counts for its customer's total.
        ("o1", "p1", 2, 21.98, 49.95, "2023-01-01"), ("o1", "p2", 1, 5.99, 49.95, "2023-01-01"),
        ("o2", "p1", 3, 32.97, 48.95, "2023-01-02"), ("o2", "p3", 2, 15.98, 48.95, "2023-01-02"),
        ("o3", "p1", 1, 10.99, 49.95, "2023-01-02")]
    bad = read_table(spark, f"{silver}/_errors/ingest_date={DAY}")
    assert tuples(bad, "order_id", "product_id", "error_reason") == [("o3", "p4", "price=NULL"), ("o4", "p1", "purchase_date=NULL")]
    # Underscore folders are not part of the table, and a rerun changes nothing.
    before = tuples(table)
    raw_to_silver(spark, raw, silver, DAY, multiline=not lines)
    assert tuples(read_table(spark, f"{silver}/order_lines")) == before


def test_quarantine_first(spark, tmp_path):
    silver = str(tmp_path / "silver")
    counts = raw_to_silver(spark, _write(tmp_path, ORDERS), silver, DAY, quarantine_first=True, errors_path=str(tmp_path / "bad"))
    assert counts.silver_lines == 5
    totals = read_table(spark, f"{silver}/order_lines").select("customer_id", F.col("customer_total_revenue").cast("double"))
    assert tuples(totals.distinct()) == [("c1", 38.96), ("c2", 48.95)]
    assert read_table(spark, str(tmp_path / "bad")).count() == 3


def test_only_touched_dates_are_replaced(spark, tmp_path):
    silver = str(tmp_path / "silver")
    raw = _write(tmp_path, ORDERS)
    _write(tmp_path, [_order("o9", "c9", "2023-01-02", ("p1", "A", "1", "1.00"))], "2025-09-26")
    raw_to_silver(spark, raw, silver, DAY)
    counts = raw_to_silver(spark, raw, silver, "2025-09-26")
    assert not counts.quarantined
    assert tuples(read_table(spark, f"{silver}/order_lines"), "order_id", "product_id") == [("o1", "p1"), ("o1", "p2"), ("o9", "p1")]


def test_corrupt_records_are_counted(spark, tmp_path):
    raw = _write(tmp_path, ORDERS[:1], lines=True)
    with open(f"{raw}/ingest_date={DAY}/more.json", "w") as file:
        file.write('{"order_id": "x", \n')
    counts = raw_to_silver(spark, raw, str(tmp_path / "silver"), DAY, multiline=False)
    assert (counts.corrupt_records, counts.quarantined, counts.silver_lines) == (1, 1, 2)
    bad = read_table(spark, str(tmp_path / "silver" / "_errors" / f"ingest_date={DAY}"))
    assert tuples(bad, "order_id", "error_reason", "corrupt_record") == [(None, "corrupt record", '{"order_id": "x", ')]


def test_empty_ingest(spark, tmp_path):
    counts = raw_to_silver(spark, _write(tmp_path, [_order("o", "c", "2023-01-01")]), str(tmp_path / "silver"), DAY)
    assert (counts.raw_orders, counts.lines, counts.silver_lines) == (1, 0, 0)


def test_silver_to_gold(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    raw_to_silver(spark, _write(tmp_path, ORDERS), silver, DAY)
    for _ in range(2):
        silver_to_gold(spark, silver, gold, top_n=1, snapshot_date=DAY)
    silver_to_gold(spark, silver, gold, top_n=1, snapshot_date="2025-09-26", write_current_tables=False, changed_dates=["2023-01-01"])
    assert sorted(os.listdir(gold)) == ["_state", "customer_revenue", "order_kpis_current", "order_kpis_snapshot", "product_revenue",
                                        "product_revenue_overall", "top_products_current", "top_products_daily", "top_products_snapshot"]
    assert read_table(spark, f"{gold}/product_revenue").count() == 4
    assert tuples(read_table(spark, f"{gold}/top_products_daily"), "product_id", "rank") == [("p1", 1), ("p1", 1)]
    assert tuples(read_table(spark, f"{gold}/top_products_current"), "product_id", "rank") == [("p1", 1)]
    assert tuples(read_table(spark, f"{gold}/top_products_snapshot").select(F.col("snapshot_date").cast("string"))) == [(DAY,), ("2025-09-26",)]
    figures = read_table(spark, f"{gold}/order_kpis_current").first()
    assert (float(figures.total_revenue), figures.order_count, float(figures.average_order_value)) == (87.91, 3, 29.3)
    no_snapshot = str(tmp_path / "gold2")
    silver_to_gold(spark, silver, no_snapshot, snapshot=False)
    assert "top_products_snapshot" not in os.listdir(no_snapshot)


def test_daily_sales_job(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        "order_id,order_ts,customer_id,product_id,qty\n1,2025-03-21T10:15:00Z,1,10,2\n2,2025-03-21T23:30:00Z,1,12,1\n3,2025-03-22T09:45:00Z,2,10,1\n")
    (tmp_path / "products.csv").write_text("product_id,sku,category,price\n10,S,Apparel,19.99\n12,M,Home,7.50\n")
    out = str(tmp_path / "out")
    for _ in range(2):
        run_daily_sales(spark, str(tmp_path / "orders.csv"), str(tmp_path / "products.csv"), out)
    assert tuples(read_table(spark, out).select(F.col("order_date").cast("string"), F.col("gross_sales").cast("double"), "orders", "units")) == [
        ("2025-03-21", 47.48, 2, 3), ("2025-03-22", 19.99, 1, 1)]
    for day in ("2025-03-21", "2025-03-22"):
        assert len([f for f in os.listdir(f"{out}/order_date={day}") if f.endswith(".parquet")]) == 1
    inferred = read_csv(spark, str(tmp_path / "orders.csv"))
    assert inferred.dtypes == [("order_id", "int"), ("order_ts", "timestamp"), ("customer_id", "int"), ("product_id", "int"), ("qty", "int")]
    declared = read_orders_csv(spark, str(tmp_path / "orders.csv"))
    assert tuples(declared) == tuples(inferred) and dict(declared.dtypes)["order_id"] == "bigint"


def test_incremental_and_full_overwrite(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(day, v)")
    path = str(tmp_path / "t")
    write_partitions(df, path, "day")
    write_partitions(df.where("day = 2").withColumn("v", F.lit("c")), path, "day", tasks=1)
    assert tuples(read_table(spark, path), "day", "v") == [(1, "a"), (2, "c")]
    write_partitions(df.where("day = 2"), path, "day", incremental=False)
    assert tuples(read_table(spark, path), "day", "v") == [(2, "b")]
    write_partitions(df.where("day = 2"), path, "day", mode="append", sort_by=["v"])
    assert tuples(read_table(spark, path), "day", "v") == [(2, "b"), (2, "b")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_crowded_partition_is_split(spark, settings, tmp_path):
    """One date with most of the data is written by several tasks."""
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB", spark__sql__adaptive__coalescePartitions__parallelismFirst="false")
    df = spark.range(40_000).repartition(8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit(1).alias("day"))
    path = str(tmp_path / "t")
    write_partitions(df, path, "day")
    assert len([f for f in os.listdir(f"{path}/day=1") if f.endswith(".parquet")]) > 1
    assert read_table(spark, path).count() == 40_000


def test_snapshots(spark, tmp_path):
    df, path = spark.range(2), str(tmp_path / "t")
    write_snapshot(df, path, "2025-01-01")
    write_snapshot(df, path, "2025-01-02")
    write_snapshot(df, path, "2025-01-02")
    assert read_table(spark, path).count() == 4
    write_snapshot(df, path, "2025-01-02", append=True)
    assert read_table(spark, path).count() == 6


def test_other_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    write_current(spark.range(3), path)
    write_current(spark.range(1), path)
    assert read_table(spark, path).count() == 1
    assert write_quarantine(spark.range(3), str(tmp_path / "q")) == 3 and read_table(spark, str(tmp_path / "q")).count() == 3
    assert write_quarantine(spark.range(0), str(tmp_path / "q")) == 0 and read_table(spark, str(tmp_path / "q")).count() == 0
    aggregated = spark.range(30).groupBy((F.col("id") % 3).alias("day")).count()
    write_one_file_each(aggregated, str(tmp_path / "d"), "day")
    assert all(len([f for f in os.listdir(tmp_path / "d" / f"day={n}") if f.endswith(".parquet")]) == 1 for n in range(3))


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.sql("SELECT * FROM VALUES (1, 'a', DATE '2025-01-01'), (2, 'b', DATE '2025-01-02'), (3, 'c', DATE '2025-01-03'), "
                     "(4, 'd', DATE '2025-01-03'), (5, 'e', null) AS t(k, v, day)")
    write_partitions(base, path, "day")
    untouched = os.listdir(f"{path}/day=2025-01-01")
    updates = spark.sql("SELECT * FROM VALUES (2, 'B', DATE '2025-01-04'), (3, 'C', DATE '2025-01-03'), (5, 'E', DATE '2025-01-04') AS t(k, v, day)")
    for _ in range(2):
        upsert_partitions(spark, path, updates, ["k"], [F.desc("day")], "day")
        assert tuples(read_table(spark, path).select("k", "v", F.col("day").cast("string"))) == [
            (1, "a", "2025-01-01"), (2, "B", "2025-01-04"), (3, "C", "2025-01-03"), (4, "d", "2025-01-03"), (5, "E", "2025-01-04")]
    assert os.listdir(f"{path}/day=2025-01-01") == untouched
    write_partitions(base.withColumn("day", F.lit("x:y")), str(tmp_path / "text"), "day")
    with pytest.raises(ValueError):
        upsert_partitions(spark, str(tmp_path / "text"), updates, ["k"], [F.desc("day")], "day")


def test_an_upsert_that_failed_halfway_is_healed_by_a_rerun(spark, tmp_path, monkeypatch):
    from ordermill.sinks import writers

    path = str(tmp_path / "t")
    write_partitions(spark.sql("SELECT * FROM VALUES (1, 'a', 2001), (2, 'b', 2002) AS t(k, v, year)"), path, "year")
    updates = spark.sql("SELECT 2 AS k, 'B' AS v, 2003 AS year")
    with monkeypatch.context() as patch:
        patch.setattr(writers, "remove", lambda spark, folder: (_ for _ in ()).throw(OSError("gone")) if "year=" in folder else None)
        with pytest.raises(OSError):
            upsert_partitions(spark, path, updates, ["k"], [F.desc("year")], "year")
    assert read_table(spark, path).count() == 3
    upsert_partitions(spark, path, updates, ["k"], [F.desc("year")], "year")
    assert tuples(read_table(spark, path), "k", "v", "year") == [(1, "a", 2001), (2, "B", 2003)]


def test_upsert_starts_no_job_per_emptied_partition(spark, tmp_path):
    def jobs(n):
        path = str(tmp_path / f"t{n}")
        write_partitions(spark.range(n).select("id", F.col("id").alias("year")), path, "year", tasks=2)
        group = f"upsert {n}"
        spark.sparkContext.setJobGroup(group, group)
        upsert_partitions(spark, path, spark.range(n).select("id", F.lit(99).cast("bigint").alias("year")), ["id"], [F.desc("year")], "year")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert sorted(d for d in os.listdir(path) if d.startswith("year=")) == ["year=99"]
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(12) <= jobs(2) + 2


def test_writes_need_adaptive_execution_or_a_number_of_tasks(spark, settings, tmp_path):
    settings(spark__sql__adaptive__enabled="false")
    df = spark.range(5).select("id", F.lit(1).alias("day"))
    with pytest.raises(RuntimeError):
        write_partitions(df, str(tmp_path / "t"), "day")
    write_partitions(df, str(tmp_path / "t"), "day", tasks=2)


def test_csv_times_without_offset_are_utc(spark, settings, tmp_path):
    (tmp_path / "o.csv").write_text("order_id,order_ts,customer_id,product_id,qty\n1,2025-03-21T23:30:00,1,10,2\n2,2025-03-21T23:30:00Z,1,10,2\n")
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        settings(spark__sql__session__timeZone=zone)
        assert {r.t for r in read_orders_csv(spark, str(tmp_path / "o.csv")).select(F.unix_timestamp("order_ts").alias("t")).collect()} == {1742599800}


def test_workspace(spark):
    with staging(spark) as folder:
        assert folder.startswith(shared_folder(spark))
        assert staged(spark.range(5), f"{folder}/x").count() == 5
        assert os.path.exists(folder)
    assert not os.path.exists(folder)


def test_calendar_and_views(spark):
    days = calendar(spark, "2024-02-28", "2024-03-01")
    assert tuples(days.select(F.col("day").cast("string"))) == [("2024-02-28",), ("2024-02-29",), ("2024-03-01",)]
    register_views(some_days=days)
    assert spark.sql("SELECT count(*) FROM some_days").first()[0] == 3
