import datetime
import json

import pytest
from pyspark.sql import functions as F

from ordermill.__main__ import arguments, main
from ordermill.sources import read_table
from tests.conftest import tuples


def test_arguments():
    gold = arguments().parse_args(["silver-to-gold", "--silver", "s", "--gold", "g", "--top-n", "3", "--no-snapshot"])
    assert (gold.top_n, gold.snapshot, gold.write_current) == (3, False, True)
    silver = arguments().parse_args(["raw-to-silver", "2025-09-25", "--raw", "r", "--silver", "s"])
    assert (silver.ingest_date, silver.dedup_strategy, silver.errors_out) == ("2025-09-25", "prefer_latest", None)
    with pytest.raises(SystemExit):
        arguments().parse_args(["raw-to-silver", "2025-09-25", "--raw", "r", "--silver", "s", "--dedup-strategy", "first"])


def _load(tmp_path, lines, *options):
    folder = tmp_path / "raw" / "ingest_date=2024-07-09"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.json").write_text("\n".join(lines))
    main(["raw-to-silver", "2024-07-09", "--raw", str(tmp_path / "raw"), "--silver", str(tmp_path / "silver"), "--json-lines", *options])


def _order(order, customer, day, *items):
    products = [dict(zip(("product_id", "name", "quantity", "price"), item)) for item in items]
    return json.dumps({"order_id": order, "customer_id": customer, "purchase_date": day, "products": products})


MUG, LID = ("mug", "Mug", "3", "4,50"), ("lid", "Lid", "10", "0.99")


def test_jobs_run_from_the_command_line(spark, tmp_path, capsys):
    rows = [_order("K1", "x", "2024-07-01", MUG, LID), _order("K2", "y", "2024/07/02", ("mug", "Mug", "some", "4.50")), _order("K3", "x", "2024-07-02", LID),
            _order("K4", "y", "2024-07-03"), '{"order_id": "K5", "products": {"product_id": "mug"}}', "no json at all"]
    _load(tmp_path, rows)
    said = capsys.readouterr().out
    assert "raw_orders=6, corrupt_records=2, lines=4, quarantined=3, silver_lines=3" in said and "datetime.date(2024, 7, 2)" in said
    # every raw order is in silver, without products, or set aside
    errors = spark.read.parquet(str(tmp_path / "silver" / "_errors" / "ingest_date=2024-07-09"))
    assert tuples(errors, "order_id", "error_reason", "corrupt_record") == sorted(
        [("K2", "quantity=NULL", None), (None, "corrupt record", rows[4]), (None, "corrupt record", rows[5])], key=repr)

    gold = str(tmp_path / "gold")
    main(["silver-to-gold", "--silver", str(tmp_path / "silver"), "--gold", gold, "--top-n", "1", "--snapshot-date", "2024-08-01"])
    assert tuples(read_table(spark, f"{gold}/top_products_current").select("product_id", F.col("revenue").cast("string"), "rank")) == [("lid", "19.80", 1)]
    assert tuples(read_table(spark, f"{gold}/order_kpis_snapshot").select(F.col("snapshot_date").cast("string"), "order_count")) == [("2024-08-01", 2)]
    assert read_table(spark, f"{gold}/product_revenue").count() == 3

    # the day corrected and loaded again: nothing is set aside any more
    _load(tmp_path, [rows[0], _order("K2", "y", "2024/07/02", ("mug", "Mug", "2", "4.50")), rows[2], rows[3]])
    assert "quarantined=0, silver_lines=4" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "silver" / "_errors" / "ingest_date=2024-07-09")).count() == 0
    main(["silver-to-gold", "--silver", str(tmp_path / "silver"), "--gold", gold, "--changed-dates", "2024-07-02", "--tasks", "2"])
    assert tuples(read_table(spark, f"{gold}/product_revenue").select(F.col("purchase_date").cast("string"), "product_id", F.col("revenue").cast("string"))) == [
        ("2024-07-01", "lid", "9.90"), ("2024-07-01", "mug", "13.50"), ("2024-07-02", "lid", "9.90"), ("2024-07-02", "mug", "9.00")]
    today = datetime.datetime.now(datetime.timezone.utc).date()
    days = {r.snapshot_date for r in read_table(spark, f"{gold}/top_products_snapshot").collect()}
    assert {str(day) for day in days} in ({"2024-08-01", str(today)}, {"2024-08-01", str(today - datetime.timedelta(days=1))})


def test_blank_ids_can_be_set_aside(spark, tmp_path, capsys):
    _load(tmp_path, [_order(" ", "x", "2024-07-01", MUG)], "--blank-ids-are-null")
    assert "quarantined=1, silver_lines=0" in capsys.readouterr().out
