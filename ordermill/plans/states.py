"""Gold figures that follow silver without reading its history again.

Of every purchase date the gold folder keeps its state: what that day's products add up to, and the lines themselves, in the
columns that figures of orders and customers need. A load replaces the states of the dates it brought. Sums add up over
days. Distinct orders do not: an order with lines on several days counts on each, so these orders, which are found in the states,
are taken off again. All states are one versioned table, so a load replaces them in one step.

Lines of one day hardly ever share an order and a product, and not many share a customer, so what orders and customers add up to
per day would have nearly as many rows as the lines, and would have to be shuffled for it. Lines go into the state as they are.
"""

from __future__ import annotations

import datetime
from collections.abc import Collection, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.fingerprint import fingerprint
from ..operators.joins import FILTER_BITS, filtered_match, match
from ..sinks import VersionedTable
from ..workspace import folder_names, staged

_PRODUCT = ["product_id", "product_name"]
_DAY = "purchase_date"
#: Lines per slice of a date and, on average, per task: half of what ``dealt`` gives a task, as some tasks get several slices.
TASK_ROWS = 275_000


def _by_day(lines: DataFrame, rows: Collection[int]) -> DataFrame:
    """``lines`` with ``_slice``, shuffled by date and slice of the products, so that a task gets no more rows when the input grows and a
    date's rows are in few tasks. The largest of the dates' ``rows`` gives the slices of a date, all of them the tasks."""
    tasks, slices = -(-sum(rows) // TASK_ROWS), max(1, -(-max(rows, default=0) // TASK_ROWS))
    sliced = lines.withColumn("_slice", F.pmod(F.xxhash64("product_id"), F.lit(slices)))
    return sliced.repartition(tasks, _DAY, "_slice") if tasks > 1 else sliced


def _product_days(lines: DataFrame, rows: Collection[int]) -> DataFrame:
    """``product_totals(lines, "daily")`` from one shuffle: the same rows serve the sums within each order and those of the products."""
    keys = [_DAY, "_slice", *_PRODUCT]
    within = _by_day(lines.select(_DAY, "order_id", *_PRODUCT, "quantity", "line_amount"), rows).groupBy(*keys, "order_id").agg(
        F.sum("line_amount").alias("amount"), F.sum("quantity").alias("units"))
    kinds = dict(within.dtypes)
    return within.groupBy(*keys).agg(
        F.sum("amount").cast(kinds["amount"]).alias("revenue"), F.sum("units").cast(kinds["units"]).alias("quantity"), F.count("order_id").alias("orders"))


def daily_states(lines: DataFrame, rows: Collection[int] = ()) -> DataFrame:
    """All states of the dates of ``lines``: ``kind``, the date and the product; of products revenue, quantity and orders (distinct), of
    lines the order, the customer and the amount. Other columns are null. ``rows`` are the numbers of lines of the dates, where known."""
    sums, own = ["revenue", "quantity", "orders"], ["order_id", "customer_id", "line_amount"]
    products = _product_days(lines, rows)
    product = products.select(F.lit("product").alias("kind"), _DAY, *_PRODUCT, *sums, *[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in own])
    line = lines.select(F.lit("line").alias("kind"), _DAY, *_PRODUCT, *[F.lit(None).cast(products.schema[c].dataType).alias(c) for c in sums], *own)
    return product.unionByName(line)


def bring_up_to_date(states: VersionedTable, lines: DataFrame, dates: set[str], gone: set[str]) -> None:
    """Make the states of ``dates`` from ``lines``, silver's lines of these dates, and take out those of the dates ``gone``.

    A version notes the fingerprint of the lines that each date's state was made from. A date whose lines have the same one has the
    same state, and keeps it: a load that comes again only costs a scan.
    """
    manifest = states.manifest()
    known = manifest.note.get("lines", {}) if manifest else {}
    days = fingerprint(lines, _DAY).select(F.col(_DAY).cast("string"), "rows", F.col("sum_a").cast("string"), F.col("sum_b").cast("string")).collect()  # a row per date
    found = {row[0]: list(row[1:]) for row in days}
    fresh = {day for day in dates if found.get(day) != known.get(day)}
    if manifest and not fresh and not gone:
        return
    noted = {day: of for day, of in known.items() if day not in fresh | gone} | {day: found[day] for day in fresh if day in found}
    rows = [found[day][0] for day in fresh if day in found]
    states.replace(daily_states(lines.where(on_dates(fresh)), rows), fresh | gone, note={"lines": noted}, sort_by=["kind", "order_id"], gather=False)


def on_dates(dates: Iterable[str]) -> Column:
    return F.col(_DAY).isin([datetime.date.fromisoformat(day) for day in dates])


def state_table(spark: SparkSession, gold_root: str) -> VersionedTable:
    return VersionedTable(spark, f"{gold_root.rstrip('/')}/_state/days", _DAY)


def stale_dates(states: VersionedTable, silver_lines: str, changed: Iterable | None) -> tuple[set[str], set[str]]:
    """The dates of silver whose states must be made anew (``changed``, by default all, and those without one) and the dates
    that silver has no longer. Silver's dates are the names of its folders; its lines all have one."""
    prefix = f"{_DAY}="
    there = {name.removeprefix(prefix) for name in folder_names(states.spark, silver_lines) if name.startswith(prefix)} - {"__HIVE_DEFAULT_PARTITION__"}
    manifest = states.manifest()
    known = set(manifest.live) if manifest else set()
    wanted = there if changed is None else {str(day) for day in changed}
    return (wanted | (there - known)) & there, known - there


def _of(states: DataFrame, kind: str) -> DataFrame:
    return states.where(F.col("kind") == kind)


def _sum_like(name: str, states: DataFrame) -> Column:
    """The sum of sums, in the type that one sum over all lines has."""
    return F.sum(name).cast(states.schema[name].dataType).alias(name)


def overall_products(states: DataFrame, folder: str | None = None) -> DataFrame:
    """``product_totals`` over all dates, from states alone. With ``folder`` the orders with lines on several days are staged there, so
    that lines of others can be left out before they are shuffled."""
    days = _of(states, "product").groupBy(*_PRODUCT).agg(_sum_like("revenue", states), _sum_like("quantity", states), F.sum("orders").alias("orders"))
    lines = _of(states, "line").select(_DAY, "order_id", *_PRODUCT)
    spread = lines.groupBy("order_id").agg(F.min(_DAY).alias("first"), F.max(_DAY).alias("last")).where("first < last AND order_id IS NOT NULL").select("order_id")
    if folder is None:
        several = match(lines, spread, "order_id", "left_semi")
    else:
        spread = staged(spread, folder)
        several = filtered_match(lines, spread, "order_id", "left_semi", bits=_filter_bits(spread.count()))
    again = several.groupBy("order_id", *_PRODUCT).agg((F.count_distinct(_DAY) - 1).alias("again")).groupBy(*_PRODUCT).agg(F.sum("again").alias("again"))
    same = [F.col(f"d.{key}").eqNullSafe(F.col(f"a.{key}")) for key in _PRODUCT]
    joined = days.alias("d").join(again.alias("a"), same[0] & same[1], "left")
    return joined.select(*[f"d.{key}" for key in _PRODUCT], "revenue", F.col("quantity").alias("total_quantity"),
                         (F.col("orders") - F.coalesce("again", F.lit(0))).alias("order_count"))


def _filter_bits(keys: int) -> int:
    """At least 8 bits a key, up to ``FILTER_BITS``: of other keys at most one in 16 passes the filter."""
    return min(FILTER_BITS, 1 << max(20, (8 * keys - 1).bit_length()))


def daily_products(states: DataFrame) -> DataFrame:
    """``product_totals(..., "daily")`` from states."""
    return _of(states, "product").select(_DAY, *_PRODUCT, "revenue", F.col("quantity").alias("total_quantity"), F.col("orders").alias("order_count"))


def order_amounts(states: DataFrame) -> DataFrame:
    """The amounts of all lines with their orders, for ``average_order_value``."""
    return _of(states, "line").select("order_id", "line_amount")


def update_customer_totals(states: VersionedTable, totals: VersionedTable) -> int | None:
    """Bring ``totals`` (customer_id, revenue, priced, lines over all dates) up to the latest states; returns its version.

    Totals note the version of the states they follow. Only what changed since is read: the states that went are taken off and
    those that came are added, so the work of a load does not grow with the history, and a load that stopped half-way
    or is run again counts once. Customers without lines are left out; a revenue without any amount is null.
    """
    until, old = states.version(), totals.manifest()
    if until is None or (old and old.note.get("states") == until):
        return old and old.number
    kind = states.manifest().schema["revenue"].dataType

    def summed_up(lines: DataFrame, sign: int = 1) -> DataFrame:
        priced = F.col("line_amount").isNotNull().cast("int")
        return lines.select("customer_id", (F.col("line_amount") * sign).cast(kind).alias("revenue"), (priced * sign).alias("priced"), F.lit(sign).alias("lines"))

    if old and old.note.get("states") in states.versions():
        went, came = states.changes(old.note["states"], until)
        parts = totals.read().select("customer_id", "revenue", "priced", "lines").unionByName(summed_up(_of(came, "line"))).unionByName(summed_up(_of(went, "line"), -1))
    else:  # no totals yet, or what they follow is gone
        parts = summed_up(_of(states.read(), "line"))
    summed = parts.groupBy("customer_id").agg(F.sum("revenue").alias("revenue"), F.sum("priced").alias("priced"), F.sum("lines").alias("lines"))
    revenue = F.when(F.col("priced") > 0, F.coalesce("revenue", F.lit(0))).cast(kind)
    return totals.replace(summed.where("lines > 0").withColumn("revenue", revenue), note={"states": until})

