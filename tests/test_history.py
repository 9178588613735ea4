from pyspark.sql import functions as F

from ordermill.operators import scd2, upsert
from ordermill.plans import dimension
from tests.conftest import plan, tuples


def test_upsert_replaces_adds_and_repeats(spark):
    target = spark.sql("SELECT * FROM VALUES (1, 'a', 1), (2, 'b', 1), (null, 'n', 1) AS t(k, v, ts)")
    updates = spark.sql("SELECT * FROM VALUES (2, 'old', 2), (2, 'new', 3), (3, 'c', 2), (null, 'm', 2) AS t(k, v, ts)")
    once = upsert(target, updates, ["k"], [F.desc("ts")])
    expected = [(1, "a", 1), (2, "new", 3), (3, "c", 2), (None, "m", 2)]
    assert tuples(once) == expected
    assert tuples(upsert(once, updates, ["k"], [F.desc("ts")])) == expected


def _shown(df):
    return tuples(df.select("k", "state", F.col("valid_from").cast("string"), F.col("valid_to").cast("string"), "is_current"))


def test_history(spark):
    dim = spark.sql("SELECT * FROM VALUES (1, 'a', DATE '2020-01-01'), (2, null, DATE '2020-01-01'), (3, 'z', DATE '2020-01-01') AS t(k, state, valid_from)")
    changes = spark.sql("""SELECT * FROM VALUES (1, 'a', DATE '2020-02-01'), (1, 'b', DATE '2020-03-01'), (1, 'c', DATE '2020-04-01'),
        (2, 'x', DATE '2020-01-01'), (4, 'n', DATE '2020-05-01') AS t(k, state, day)""")
    expected = [
        (1, "a", "2020-01-01", "2020-03-01", False), (1, "b", "2020-03-01", "2020-04-01", False), (1, "c", "2020-04-01", None, True),
        (2, "x", "2020-01-01", None, True), (3, "z", "2020-01-01", None, True), (4, "n", "2020-05-01", None, True)]
    history = scd2(dim, changes, ["k"], ["state"], "day")
    assert _shown(history) == sorted(expected, key=repr)
    # The same changes again, and then a late one between two versions.
    assert _shown(scd2(history, changes, ["k"], ["state"], "day")) == sorted(expected, key=repr)
    late = spark.sql("SELECT 1 AS k, 'l' AS state, DATE '2020-03-15' AS day")
    again = [r for r in _shown(scd2(history, late, ["k"], ["state"], "day")) if r[0] == 1]
    assert again == [(1, "a", "2020-01-01", "2020-03-01", False), (1, "b", "2020-03-01", "2020-03-15", False),
                     (1, "c", "2020-04-01", None, True), (1, "l", "2020-03-15", "2020-04-01", False)]


def test_null_and_text_states_differ(spark):
    dim = spark.sql("SELECT 1 AS k, CAST(null AS STRING) AS state, DATE '2020-01-01' AS valid_from")
    changes = spark.sql("SELECT 1 AS k, '' AS state, DATE '2020-02-01' AS day")
    assert len(_shown(scd2(dim, changes, ["k"], ["state"], "day"))) == 2


def test_a_history_is_shuffled_once(spark):
    dim = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("state"), F.lit("2020-01-01").cast("date").alias("valid_from"))
    changes = spark.range(300).select((F.col("id") % 100).alias("k"), F.col("id").cast("string").alias("state"), F.expr("date_add(DATE '2020-02-01', cast(id as int))").alias("day"))
    history = scd2(dim, changes, ["k"], ["state"], "day", group_bound=4)
    assert plan(history).count("hashpartitioning") == 1
    assert tuples(history) == tuples(scd2(dim, changes, ["k"], ["state"], "day", group_rows=1))


def test_a_load_bounds_its_groups_without_joining_twice(spark, tmp_path, monkeypatch):
    bounds = []

    def watched(history, changes, *args, group_bound):
        largest = history.select("k").unionByName(changes.select("k")).groupBy("k").count().agg(F.max("count")).first()[0]
        bounds.append((group_bound, largest))
        return scd2(history, changes, *args, group_bound=group_bound)

    monkeypatch.setattr(dimension, "scd2", watched)
    table = dimension.history_table(spark, str(tmp_path / "h"))
    for days in ((1, 2), (3, 4, 5), (2, 6)):  # the last load is late
        rows = ", ".join(f"({k}, 's{d}', DATE '2020-01-0{d}')" for d in days for k in ("1", "2", "CAST(null AS INT)"))
        dimension.apply_changes(table, spark.sql(f"SELECT * FROM VALUES {rows} AS t(k, state, day)"), ["k"], ["state"], "day", buckets=2)
    assert bounds[0][0] is None and all(bound >= largest for bound, largest in bounds[1:])
    assert bounds[1] == (4, 4)
    shown = [tuple(map(str, r)) for r in dimension.read_history(table).where("k = 1").orderBy("valid_from").select("state", "valid_to").collect()]
    assert shown == [("s1", "2020-01-02"), ("s2", "2020-01-03"), ("s3", "2020-01-04"), ("s4", "2020-01-05"), ("s5", "2020-01-06"), ("s6", "None")]
