"""Keys, day buckets, JSON and text fields, pivots, upserts and type-2 history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import day_bucket, day_of, surrogate_key
from ..operators import json_fields, pivot, scd2, unpivot, upsert
from .tables import table


def order_keys(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("o_orderkey", "o_custkey", "o_orderstatus")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        surrogate_key(*columns).alias("sk"),
        surrogate_key(*columns, bits=128).alias("sk_md5"),
        surrogate_key(F.nullif("o_orderstatus", F.lit("P")), "o_custkey", null_marker="?").alias("sk_marked"),
    )


def events_per_day(spark: SparkSession, folder: str) -> DataFrame:
    bucket = day_bucket("ts").alias("day_bucket")
    return table(spark, folder, "events").groupBy(bucket, "event_type").agg(F.count(F.lit(1)).alias("events"))


def event_fields(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "props")
    return json_fields(events, "props", "k INT").select(
        "event_id", "k", F.get_json_object("props", "$.k").alias("k_text")
    )


def name_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the product name, and the number in the brand."""
    words = F.split("p_name", " ")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        words[0].alias("first_word"),
        F.try_element_at(words, F.lit(2)).alias("second_word"),
        F.regexp_extract("p_brand", r"(\d+)$", 1).alias("brand_no"),
    )


def open_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """Open orders next to all others."""
    totals = table(spark, folder, "orders").select(
        F.year(day_of("o_orderdate")).alias("year"), "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("total")
    )
    return pivot(totals, ["year"], "o_orderstatus", ["O"], "total")


def status_by_year(spark: SparkSession, folder: str) -> DataFrame:
    totals = table(spark, folder, "orders").select(
        F.year(day_of("o_orderdate")).alias("year"), "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("total")
    )
    return pivot(totals, ["year"], "o_orderstatus", ["F", "O", "P"], "total")


def line_metrics(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )
    return unpivot(lines, ["order_id", "line_no"], ["discount", "tax"])


def merged_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders after an update: pending ones closed and re-closed, open ones copied to new ids."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        day_of("o_orderdate").alias("updated"),
    )
    pending = orders.where(F.col("status") == "P")
    updates = (
        pending.select("order_id", F.lit("C").alias("status"), F.date_add("updated", 30).alias("updated"))
        .unionByName(pending.select("order_id", F.lit("F").alias("status"), F.date_add("updated", 60).alias("updated")))
        .unionByName(
            orders.where(F.col("status") == "O")
            .select((F.col("order_id") + 1_000_000_000_000).alias("order_id"), "status", "updated")
        )
    )
    return upsert(orders, updates, ["order_id"], [F.col("updated").desc_nulls_last()])


def _priorities(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Customers with no priority at first, and the priority of their best order on each day."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.lit("NONE").alias("priority"),
        F.lit("1900-01-01").cast("date").alias("valid_from"),
    )
    changes = table(spark, folder, "orders").groupBy(
        F.col("o_custkey").alias("customer_id"), day_of("o_orderdate").alias("seen")
    ).agg(F.min("o_orderpriority").alias("priority"))
    return customers, changes


def customer_history(spark: SparkSession, folder: str) -> DataFrame:
    customers, changes = _priorities(spark, folder)
    return scd2(customers, changes, ["customer_id"], ["priority"], "seen")


def order_history(spark: SparkSession, folder: str) -> DataFrame:
    """History of two columns: a text with bars in it, and one that is often null."""
    seen = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"), day_of("o_orderdate").alias("seen"), "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, "x|y").otherwise("x").alias("left_part"),
        F.when(F.col("o_orderkey") % 3 == 0, "z").when(F.col("o_orderkey") % 3 == 1, "y|z").alias("right_part"))
    first = seen.groupBy("customer_id", "seen").agg(F.min_by(F.struct("left_part", "right_part"), "o_orderkey").alias("state"))
    none = first.limit(0).select("customer_id", "state.left_part", "state.right_part", F.col("seen").alias("valid_from"))
    changes = first.select("customer_id", "state.left_part", "state.right_part", "seen")
    return scd2(none, changes, ["customer_id"], ["left_part", "right_part"], "seen")


QUERIES = {
    "surrogate_key": order_keys,
    "day_bucket": events_per_day,
    "event_json_fields": event_fields,
    "text_fields": name_parts,
    "pivot_status": status_by_year,
    "unpivot_metrics": line_metrics,
    "pivot_open_or_other": open_by_year,
    "upsert_orders": merged_orders,
    "scd2_customer": customer_history,
    "scd2_two_columns": order_history,
}

SQL = {
    "scd2_two_columns": """WITH s AS (SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS day, min(o_orderkey) AS k FROM orders GROUP BY 1, 2),
v AS (SELECT customer_id, day, CASE WHEN k % 3 = 0 THEN 'x|y' ELSE 'x' END AS l, CASE k % 3 WHEN 0 THEN 'z' WHEN 1 THEN 'y|z' END AS r FROM s),
c AS (SELECT *, row_number() OVER w AS n, lag(l) OVER w AS pl, lag(r) OVER w AS pr FROM v WINDOW w AS (PARTITION BY customer_id ORDER BY day)),
k AS (SELECT * FROM c WHERE n = 1 OR l IS DISTINCT FROM pl OR r IS DISTINCT FROM pr),
d AS (SELECT *, lead(day) OVER (PARTITION BY customer_id ORDER BY day) AS until FROM k)
SELECT customer_id, l AS left_part, r AS right_part, CAST(day AS VARCHAR) AS valid_from, CAST(until AS VARCHAR) AS valid_to, until IS NULL AS is_current FROM d""",
    "surrogate_key": """SELECT o_orderkey AS order_id, sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus)) AS sk,
  md5(concat_ws('|', o_orderkey, o_custkey, o_orderstatus)) AS sk_md5,
  sha256(CASE WHEN o_orderstatus = 'P' THEN '?' ELSE o_orderstatus END || '|' || o_custkey) AS sk_marked FROM orders""",
    "day_bucket": """SELECT date_trunc('day', ts)::TIMESTAMP AS day_bucket, event_type, count(*) AS events FROM events GROUP BY 1, 2""",
    "event_json_fields": """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
  json_extract_string(props, '$.k') AS k_text FROM events""",
    "text_fields": """SELECT p_partkey AS product_id, split_part(p_name, ' ', 1) AS first_word,
  nullif(split_part(p_name, ' ', 2), '') AS second_word, regexp_extract(p_brand, '(\\d+)$', 1) AS brand_no FROM part""",
    "pivot_status": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS "F",
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS "O",
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS "P",
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')) AS DOUBLE) AS other
FROM orders GROUP BY 1""",
    "pivot_open_or_other": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS "O",
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus <> 'O') AS DOUBLE) AS other
FROM orders GROUP BY 1""",
    "unpivot_metrics": """SELECT l_orderkey AS order_id, l_linenumber AS line_no, 'discount' AS metric, l_discount AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem""",
    "upsert_orders": """WITH o AS (SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS updated FROM orders)
SELECT order_id, CASE WHEN status = 'P' THEN 'F' ELSE status END AS status,
       CAST(CASE WHEN status = 'P' THEN updated + 60 ELSE updated END AS VARCHAR) AS updated FROM o
UNION ALL SELECT order_id + 1000000000000, status, CAST(updated AS VARCHAR) FROM o WHERE status = 'O'""",
    "scd2_customer": """WITH v AS (
  SELECT c_custkey AS customer_id, 'NONE' AS priority, DATE '1900-01-01' AS valid_from FROM customer UNION ALL
  SELECT o_custkey, min(o_orderpriority), CAST(o_orderdate AS DATE) FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)),
c AS (SELECT *, lag(priority) OVER (PARTITION BY customer_id ORDER BY valid_from) AS previous FROM v),
k AS (SELECT * FROM c WHERE previous IS NULL OR previous <> priority),
d AS (SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to FROM k)
SELECT customer_id, priority, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
       valid_to IS NULL AS is_current FROM d""",
}
