"""Rolling ranges, fingerprints, clustered files, key filters and pruned scans."""

import datetime
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ordermill.operators import match, rolling_days
from ordermill.operators.fingerprint import differing_groups, fingerprint, watched
from ordermill.operators.joins import filtered_match, key_filter, maybe_in, on_chosen
from ordermill.sinks import write_partitions
from ordermill.sinks.clustering import write_clustered, z_value
from tests.conftest import plan, tuples


@pytest.fixture(scope="module")
def sales(spark):
    pick = random.Random(4)
    days = [None, *(datetime.date(2023, 12, 1) + datetime.timedelta(k * k % 500) for k in range(60))]
    rows = [(pick.choice(["crowd", "crowd", "b", "c", None]), pick.choice(["x", "y"]), pick.choice(days), pick.choice([None, pick.randint(-5, 50)])) for _ in range(900)]
    return spark.createDataFrame(rows, "key string, kind string, day date, amount long").withColumn("amount", F.col("amount").cast("decimal(12,2)"))


@pytest.mark.parametrize("days, slice_days", [(1, 366), (7, 9), (7, 1), (400, 366)])
def test_rolling_days_equal_one_range_window(spark, sales, days, slice_days):
    sales.groupBy("key", "kind", "day").agg(F.sum("amount").alias("amount")).createOrReplaceTempView("rolled")
    want = spark.sql(f"""SELECT *, CAST(sum(amount) OVER (PARTITION BY key, kind ORDER BY unix_date(day) RANGE BETWEEN {days - 1} PRECEDING AND CURRENT ROW) AS STRING) AS s FROM rolled""")
    got = rolling_days(sales, ["key", "kind"], "day", "amount", days, "s", slice_days)
    assert got.columns == ["key", "kind", "day", "amount", "s"]
    assert tuples(got.withColumn("s", F.col("s").cast("string"))) == tuples(want)


def test_rolling_days_without_groups_and_days_before_1970(spark):
    rows = spark.sql("SELECT date_add(DATE'1969-12-20', cast(id * 3 as int)) AS day, id AS v FROM range(20)")
    got = {r.day: r.s for r in rolling_days(rows, [], "day", "v", 7, "s", 8).collect()}
    assert list(dict(sorted(got.items())).values()) == [0, 1, *(3 * k - 3 for k in range(2, 20))]
    with pytest.raises(ValueError):
        rolling_days(rows.withColumn("day", F.col("day").cast("string")), [], "day", "v")


@pytest.fixture
def copies(spark):
    return spark.createDataFrame([(g, k, f"v{k % 5}" if k % 4 else None, k * 1.5) for g in "abcd" for k in range(50)], "g string, k long, v string, x double")


def test_every_difference_is_found(spark, copies):
    def names(other):
        return sorted(r.g for r in differing_groups(copies, other, "g").collect())

    assert names(copies.orderBy(F.desc("k")).repartition(7)) == []
    assert names(copies.withColumn("x", F.when((F.col("g") == "a") & (F.col("k") == 7), 0.0).otherwise(F.col("x")))) == ["a"]
    swapped = copies.withColumn("v", F.when((F.col("g") == "b") & F.col("k").isin(1, 2), F.when(F.col("k") == 1, "v2").otherwise("v1")).otherwise(F.col("v")))
    assert names(swapped) == ["b"]
    assert names(copies.union(copies.where("g = 'c' and k = 3"))) == ["c"]
    assert names(copies.union(copies.where("g = 'c' and k = 3")).where("g <> 'c' or k <> 4")) == ["c"]  # as many rows as before
    assert names(copies.where("g <> 'd'").union(spark.createDataFrame([("e", 1, "v", 1.0)], copies.schema))) == ["d", "e"]


def test_a_value_in_the_next_column_differs(spark):
    one = spark.createDataFrame([(None, "a", None), ("a", None, None)], "p string, q string, r string")
    two = spark.createDataFrame([(None, None, "a"), ("a", None, None)], one.schema)
    assert tuples(fingerprint(one)) != tuples(fingerprint(two))
    assert differing_groups(one, two, "p").count() == 1
    with pytest.raises(ValueError):
        differing_groups(one, two.withColumn("r", F.lit(1)), "p")


def test_fingerprint_of_the_pass_that_writes(spark, copies, tmp_path):
    passing, seen = watched(copies)
    passing.write.parquet(str(tmp_path / "t"))
    stored = fingerprint(spark.read.parquet(str(tmp_path / "t"))).first()
    assert seen.get == stored.asDict() and seen.get["rows"] == 200


def test_filters_on_any_clustered_column_skip_row_groups(spark, tmp_path):
    rows = spark.range(40_000).select((F.xxhash64("id") % 1000).alias("a"), (F.pow(F.abs(F.xxhash64("id", F.lit(1)) % 1000) / 10, 2)).alias("b"),
                                      F.concat(F.lit("name"), F.abs(F.xxhash64(F.lit(2), "id") % 900).cast("string")).alias("c"), "id")
    write_clustered(rows, str(tmp_path / "z"), ["a", "b"], files=64)
    assert tuples(spark.read.parquet(str(tmp_path / "z")).agg(F.sum("id"), F.count("*"))) == tuples(rows.agg(F.sum("id"), F.count("*")))

    def read(column, value):
        groups = [pq.ParquetFile(f).metadata.row_group(g) for f in glob.glob(f"{tmp_path}/z/*.parquet") for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
        place = ["a", "b"].index(column)
        hit = [g for g in groups if g.column(place).statistics.min <= value <= g.column(place).statistics.max]
        return len(hit) / len(groups)

    for column, value in (("a", 17), ("a", -700), ("b", 4.0), ("b", 8000.0)):
        assert read(column, value) < 0.3
    assert z_value(rows, ["c"]) is not None
    with pytest.raises(ValueError):
        z_value(rows, ["a", "b"], bits=32)


def test_z_values_interleave_ranks(spark):
    rows = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)] + [(None, 0)], "x long, y long")
    got = {(r.x, r.y): r.z for r in rows.select("x", "y", z_value(rows, ["x", "y"], bits=2).alias("z")).collect()}
    assert got[None, 0] == 0 and got[0, 0] == 0
    for (x, y), z in got.items():
        if x is not None:
            assert z == sum((x >> b & 1) << (2 * b + 1) | (y >> b & 1) << (2 * b) for b in range(2))


def shuffled(df):
    """Bytes written by the shuffles of a run of ``df``."""
    df.write.format("noop").mode("overwrite").save()
    store = df.sparkSession.sparkContext._jsc.sc().statusStore()
    return store.executorSummary("driver").totalShuffleWrite()


def test_a_key_filter_keeps_all_partners_and_drops_most_others(spark):
    facts = spark.range(60_000).select((F.col("id") % 20_000).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("j"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    few = spark.range(0, 20_000, 40).select(F.col("id").alias("k"), (F.col("id") % 3).alias("j"), F.lit("w").alias("w"))
    for on in (["k"], ["k", "j"]):
        left = maybe_in(facts, on, key_filter(few.select(*on), 1 << 16), 1 << 16)
        assert left.columns == facts.columns
        partners = match(facts, few, on, "left_semi")
        assert partners.exceptAll(left).count() == 0 and left.count() < partners.count() + 600
        for how in ("inner", "left_semi"):
            assert tuples(filtered_match(facts, few, on, how, broadcast_keys=0, bits=1 << 16)) == tuples(match(facts, few, on, how))
            assert tuples(filtered_match(facts, few, on, how)) == tuples(match(facts, few, on, how))
    assert filtered_match(facts, few.limit(0), "k", broadcast_keys=-1).count() == 0
    with pytest.raises(ValueError):
        filtered_match(facts, few, "k", "left")


def test_a_key_filter_saves_shuffle(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    facts = spark.range(200_000).select((F.col("id") % 50_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    few = spark.range(0, 50_000, 100).select(F.col("id").alias("k"))
    before = shuffled(spark.range(1))
    plain = shuffled(match(facts, few, "k")) - before
    with_filter = shuffled(filtered_match(facts, few, "k", broadcast_keys=0, bits=1 << 20)) - before - plain
    assert with_filter < plain / 5
    assert "BroadcastHashJoin" in plan(filtered_match(facts, few, "k")) and "SortMergeJoin" not in plan(filtered_match(facts, few, "k"))


def test_chosen_dates_prune_the_scan(spark, sales, tmp_path):
    write_partitions(sales.where("day is not null"), str(tmp_path / "silver"), "day")
    silver = spark.read.parquet(str(tmp_path / "silver"))
    days = silver.select("day").distinct().orderBy("day").limit(9).withColumn("n", F.dayofmonth("day"))
    days.coalesce(1).write.parquet(str(tmp_path / "days"))
    chosen = spark.read.parquet(str(tmp_path / "days")).where("n % 2 = 0").select("day")
    got = on_chosen(silver, chosen, "day")
    assert "dynamicpruning" in plan(got).lower()
    assert tuples(got) == tuples(match(silver, chosen, "day", "left_semi"))
    assert tuples(on_chosen(silver, chosen, "day", broadcast_keys=0)) == tuples(got)
