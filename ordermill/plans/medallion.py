"""Raw to silver and silver to gold."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.lines import (
    cleanse, deduplicate, explode_lines, split_valid, with_customer_total, with_line_amount,
)
from ..operators.metrics import average_order_value, top_of_totals
from ..schemas import CORRUPT
from ..sinks import VersionedTable, write_current, write_partitions, write_quarantine, write_snapshot
from ..sources import ingest_path, read_raw_orders
from ..workspace import staged, staging
from .states import bring_up_to_date, daily_products, on_dates, order_amounts, overall_products, stale_dates, state_table, update_customer_totals


@dataclass(frozen=True)
class SilverCounts:
    """What a load did, counted from what it stored, but for raw orders: those are counted while the job reads
    them, so a stage that had to be repeated counts twice."""

    raw_orders: int
    corrupt_records: int
    lines: int
    quarantined: int
    silver_lines: int
    purchase_dates: tuple[datetime.date, ...]


def raw_to_silver(
    spark: SparkSession,
    raw_root: str,
    silver_root: str,
    ingest_date: datetime.date | str,
    *,
    strategy: str = "prefer_latest",
    errors_path: str | None = None,
    multiline: bool = True,
    quarantine_first: bool = False,
    blank_ids_are_null: bool = False,
    tasks: int | None = None,
) -> SilverCounts:
    """Clean one ingest day into ``<silver>/order_lines``, replacing the purchase dates it has.

    Rows without a critical value go to ``<silver>/_errors/ingest_date=<day>``, and so does every record that
    is no order: its text is in ``corrupt_record``, and its reason ``corrupt record``. A rerun replaces that
    folder, also by an empty one. By default duplicates are removed and customer totals computed before bad
    rows are set aside, so totals include them; ``quarantine_first`` turns that round.

    The raw data is read once: corrupt records and unique lines are staged, and the outputs read the stage.
    Which rows are bad is seen before the customer totals are joined. ``tasks`` is passed to ``write_partitions``.
    """
    errors_path = errors_path or f"{silver_root.rstrip('/')}/_errors/ingest_date={ingest_date}"
    raw = read_raw_orders(spark, ingest_path(raw_root, ingest_date), multiline)
    seen = Observation("raw")
    raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"))
    with staging(spark) as folder:
        lines = cleanse(explode_lines(raw, keep=CORRUPT), blank_ids_are_null)
        lines = staged(lines, f"{folder}/lines")
        corrupt, lines = lines.where(F.col(CORRUPT).isNotNull()), lines.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        if quarantine_first:
            valid, bad = split_valid(lines)
            unique = staged(deduplicate(valid, strategy=strategy), f"{folder}/unique")
            good = with_customer_total(with_line_amount(unique))
            bad = with_line_amount(bad).withColumn("customer_total_revenue", F.lit(None).cast(good.schema["customer_total_revenue"].dataType))
            kept = unique
        else:
            unique = staged(deduplicate(lines, strategy=strategy), f"{folder}/unique")
            totalled = with_customer_total(with_line_amount(unique))
            good, bad = split_valid(totalled)
            kept = split_valid(unique)[0]
        rejected = bad.select(*good.columns, "error_reason", F.lit(None).cast("string").alias("corrupt_record")).unionByName(
            corrupt.select(F.lit("corrupt record").alias("error_reason"), F.col(CORRUPT).alias("corrupt_record")), allowMissingColumns=True)
        quarantined = write_quarantine(rejected, errors_path)
        write_partitions(good, f"{silver_root.rstrip('/')}/order_lines", "purchase_date", sort_by=["product_id"], tasks=tasks)
        days = kept.groupBy("purchase_date").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per date
        return SilverCounts(
            seen.get["rows"], corrupt.count(), lines.count(), quarantined, sum(day.n for day in days),
            tuple(sorted(day.purchase_date for day in days)),
        )


def silver_to_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    *,
    top_n: int = 10,
    snapshot_date: datetime.date | str | None = None,
    snapshot: bool = True,
    write_current_tables: bool = True,
    changed_dates: Sequence[datetime.date | str] | None = None,
    tasks: int | None = None,
) -> None:
    """Publish product revenue (daily and overall), top products, customer totals and order figures.

    ``changed_dates`` are the purchase dates that silver has anew; by default all. Silver is read in one step, and only these
    dates of it, besides dates that gold has not seen. What each date adds up to is kept under ``<gold>/_state`` (see
    ``plans.states``), and made anew where the date's lines are others than before; overall tables are made from that, and
    customer totals from what changed of it. Daily tables are written for the dates that were read; dates that silver has no
    longer are taken out of the overall tables.
    ``tasks`` is passed to ``write_partitions``.
    """
    gold, lines_path = gold_root.rstrip("/"), f"{silver_root.rstrip('/')}/order_lines"
    day = snapshot_date or datetime.datetime.now(datetime.timezone.utc).date()
    states, customers = state_table(spark, gold), VersionedTable(spark, f"{gold}/_state/customers")
    dates, gone = stale_dates(states, lines_path, changed_dates)

    with staging(spark) as folder:
        silver = spark.read.parquet(lines_path)
        if dates or gone or states.version() is None:
            narrow = ["purchase_date", "order_id", "customer_id", "product_id", "product_name", "quantity", "line_amount"]
            bring_up_to_date(states, silver.where(on_dates(dates)).select(*narrow), dates, gone)
        update_customer_totals(states, customers)
        states.vacuum()
        customers.vacuum()

        known = states.read()
        daily = daily_products(known.where(on_dates(dates)))
        write_partitions(daily, f"{gold}/product_revenue", "purchase_date", tasks=tasks, gather=False)  # a date's states are in few files
        write_partitions(top_of_totals(daily, top_n, "daily"), f"{gold}/top_products_daily", "purchase_date", tasks=tasks)

        write_current(overall_products(known, f"{folder}/spread"), f"{gold}/product_revenue_overall")
        write_current(customers.read().select("customer_id", F.col("revenue").alias("customer_total_revenue"), "lines"), f"{gold}/customer_revenue")
        totals = spark.read.parquet(f"{gold}/product_revenue_overall")
        top = staged(top_of_totals(totals, top_n, "overall"), f"{folder}/top")
        figures = staged(average_order_value(order_amounts(known)), f"{folder}/figures")
        if snapshot:
            write_snapshot(top, f"{gold}/top_products_snapshot", day)
            write_snapshot(figures, f"{gold}/order_kpis_snapshot", day)
        if write_current_tables:
            write_current(top, f"{gold}/top_products_current")
            write_current(figures, f"{gold}/order_kpis_current")
