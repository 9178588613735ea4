"""Tables that change all at once, and the history and gold states kept in them."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from ordermill.operators import average_order_value, product_totals, scd2
from ordermill.plans import silver_to_gold
from ordermill.plans.dimension import apply_changes, history_table, read_history
from ordermill.plans.states import daily_states, order_amounts, overall_products, state_table, update_customer_totals
from ordermill.sinks import ChangedMeanwhile, VersionedTable, write_partitions
from ordermill.sources import read_table
from tests.conftest import plan, tuples


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, day string, v string")


FIRST = [(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, "c", "x"), (None, "c", "x"), (5, None, "x")]


@pytest.fixture
def table(spark, tmp_path):
    out = VersionedTable(spark, str(tmp_path / "t"), "day")
    out.replace(frame(spark, *FIRST))
    return out


def files(table):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{table.path}/data") for f in names}


def test_partitions_are_replaced_added_and_removed(spark, table):
    before = files(table)
    assert table.read().columns == ["k", "day", "v"] and tuples(table.read()) == sorted(FIRST, key=repr)
    assert table.replace(frame(spark, (7, "b", "y"), (8, "d", "y")), ["a"]) == 2
    assert tuples(table.read()) == sorted([(7, "b", "y"), (8, "d", "y"), (4, "c", "x"), (None, "c", "x"), (5, None, "x")], key=repr)
    assert tuples(table.read(1)) == sorted(FIRST, key=repr)
    assert before.items() <= files(table).items()
    table.replace(frame(spark, (9, None, "z")), [])
    assert tuples(table.read().where("day is null")) == [(9, None, "z")]
    assert tuples(table.read(values=["c", "nowhere"])) == sorted([(4, "c", "x"), (None, "c", "x")], key=repr)
    table.replace(frame(spark).limit(0))
    assert table.read().count() == 0 and table.versions() == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        table.replace(frame(spark, (1, "a", "b")).withColumn("w", F.lit(1)), ["a"])
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, f"{table.path}2").read()


def test_whole_table_and_note(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.version() is None and table.manifest() is None
    table.replace(frame(spark, *FIRST), note={"seen": 3})
    table.replace(frame(spark, (1, "a", "n")), note={"seen": 4})
    assert tuples(table.read()) == [(1, "a", "n")] and table.manifest().note == {"seen": 4} and table.manifest(1).note == {"seen": 3}


def test_plain_scan_where_a_load_is_whole(spark, table):
    assert "Join" not in plan(table.read())
    table.replace(frame(spark, (7, "b", "y")), [])
    assert "BroadcastHashJoin" in plan(table.read())


def test_changes_between_versions(spark, table):
    table.replace(frame(spark, (3, "b", "x"), (6, "b", "y"), (8, "d", "y")), ["a"])
    went, came = table.changes(1)
    assert tuples(went) == [(1, "a", "x"), (2, "a", "x"), (3, "b", "x")] and tuples(came) == [(3, "b", "x"), (6, "b", "y"), (8, "d", "y")]
    assert [df.count() for df in table.changes(2, 2)] == [0, 0]


def updates(spark):
    rows = [(1, "b", "moved", 1), (2, "a", "old", 1), (2, "a", "new", 2), (3, "b", "gone", 5), (None, "c", "null", 1), (9, "e", "added", 1), (77, "q", "gone", 1)]
    return spark.createDataFrame(rows, "k long, day string, v string, at long")


MERGED = sorted([(1, "b", "moved"), (2, "a", "new"), (4, "c", "x"), (None, "c", "null"), (5, None, "x"), (9, "e", "added")], key=repr)


def test_merge(spark, table):
    for _ in range(2):
        table.merge(updates(spark), ["k"], [F.desc("at")], F.col("v") == "gone")
        assert tuples(table.read()) == MERGED
    live = table.manifest()
    assert live.live[None] == table.manifest(1).live[None]  # no row of that partition was touched
    assert table.merge(updates(spark).where("k = 77"), ["k"], [F.desc("at")], F.lit(True)) == live.number


def test_whole_tables_merge(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(frame(spark, *FIRST))
    table.merge(updates(spark), ["k"], [F.desc("at")], F.col("v") == "gone")
    assert tuples(table.read()) == MERGED


class Stops(VersionedTable):
    """Stops at its n-th step of whatever kind."""

    left = 0

    def _step(self):
        self.left -= 1
        if self.left == 0:
            raise InterruptedError

    def _at(self, path):
        self._step()
        return super()._at(path)

    def _values(self, df):
        self._step()
        return super()._values(df)

    def _commit(self, manifest):
        self._step()
        super()._commit(manifest)
        self._step()


def test_a_reader_sees_the_old_or_the_new_table_wherever_a_merge_stops(spark, table):
    old, seen = sorted(FIRST, key=repr), []
    for left in range(1, 40):
        writer = Stops(spark, table.path, "day")
        writer.left = left
        try:
            writer.merge(updates(spark), ["k"], [F.desc("at")], F.col("v") == "gone")
        except InterruptedError:
            pass
        else:
            break
        seen.append(tuples(table.read()))
        assert seen[-1] in (old, MERGED)
    assert old in seen and MERGED in seen and tuples(table.read()) == MERGED
    table.vacuum(1)
    assert tuples(table.read()) == MERGED and len(table.versions()) == 1


def test_a_draft_that_never_got_its_name_is_not_read(spark, table, monkeypatch):
    drafts = f"{table.path}/manifest/.draft"
    with open(drafts, "w") as out:
        out.write('{"schema": ')
    assert tuples(table.read()) == sorted(FIRST, key=repr) and table.versions() == [1]


def test_one_of_two_writers_wins(spark, table, monkeypatch):
    other = VersionedTable(spark, table.path, "day")
    old = other.manifest()
    table.replace(frame(spark, (7, "b", "y")), [])
    monkeypatch.setattr(other, "manifest", lambda version=None: old)
    with pytest.raises(ChangedMeanwhile):
        other.replace(frame(spark, (8, "b", "z")), [])
    assert tuples(table.read().where("day = 'b'")) == [(7, "b", "y")]


def test_vacuum_removes_what_no_kept_version_uses(spark, table):
    for k in range(3):
        table.replace(frame(spark, (k, "a", "y")), [])
    table.vacuum(2)
    assert table.versions() == [3, 4] and tuples(table.read().where("day = 'a'")) == [(2, "a", "y")] and tuples(table.read(3).where("day = 'a'")) == [(1, "a", "y")]
    assert len(os.listdir(f"{table.path}/data")) == 3


# History


def history_rows(df):
    return tuples(df.select("k", "state", F.col("valid_from").cast("string"), F.col("valid_to").cast("string"), "is_current"))


def changes(spark, rows):
    return spark.createDataFrame([(k, s, datetime.date(2020, 1, 1) + datetime.timedelta(d)) for k, s, d in rows], "k long, state string, day date")


@pytest.mark.parametrize("buckets", [1, 7])
def test_loads_in_order_give_the_whole_history(spark, tmp_path, buckets):
    pick = random.Random(buckets)
    rows = [(pick.choice([None, *range(12)]), pick.choice(["a", "b", None]), day) for day in range(60) for _ in range(2)]
    rows = list({(k, d): (k, s, d) for k, s, d in rows}.values())
    table = history_table(spark, str(tmp_path / "h"))
    for low in range(0, 60, 15):
        apply_changes(table, changes(spark, [r for r in rows if low <= r[2] < low + 15]), ["k"], ["state"], "day", buckets)
    every = changes(spark, rows)
    none = every.limit(0).withColumnRenamed("day", "valid_from")
    assert history_rows(read_history(table)) == history_rows(scd2(none, every, ["k"], ["state"], "day"))
    again = table.versions()[-1]
    apply_changes(table, changes(spark, [r for r in rows if r[2] >= 45]), ["k"], ["state"], "day", buckets)
    assert history_rows(read_history(table)) == history_rows(read_history_at(table, again))


def read_history_at(table, version):
    return table.read(version).drop("part")


def test_closed_versions_are_not_touched(spark, tmp_path):
    table = history_table(spark, str(tmp_path / "h"))
    apply_changes(table, changes(spark, [(k, "a", 0) for k in range(30)]), ["k"], ["state"], "day")
    apply_changes(table, changes(spark, [(k, "b", 5) for k in range(30)]), ["k"], ["state"], "day")
    before, live = files(table), table.manifest().live
    apply_changes(table, changes(spark, [(3, "c", 9), (4, "b", 9), (99, "n", 9)]), ["k"], ["state"], "day")
    after = table.manifest().live
    assert before.items() <= files(table).items()
    same = {value for value, load in live.items() if after.get(value) == load}
    assert {value for value in live if value.startswith("closed-")} <= same and len(live) - len(same) <= 3
    assert [r for r in history_rows(read_history(table)) if r[0] in (3, 4, 99)] == sorted([
        (3, "a", "2020-01-01", "2020-01-06", False), (3, "b", "2020-01-06", "2020-01-10", False), (3, "c", "2020-01-10", None, True),
        (4, "a", "2020-01-01", "2020-01-06", False), (4, "b", "2020-01-06", None, True), (99, "n", "2020-01-10", None, True)], key=repr)


def test_late_changes_and_corrections(spark, tmp_path):
    table = history_table(spark, str(tmp_path / "h"))
    apply_changes(table, changes(spark, [(1, "a", 0), (2, "a", 0)]), ["k"], ["state"], "day")
    apply_changes(table, changes(spark, [(1, "b", 10), (2, "b", 10)]), ["k"], ["state"], "day")
    apply_changes(table, changes(spark, [(1, "m", 5), (2, "a", 10)]), ["k"], ["state"], "day")  # late, and undone on its day
    assert history_rows(read_history(table)) == sorted([
        (1, "a", "2020-01-01", "2020-01-06", False), (1, "m", "2020-01-06", "2020-01-11", False), (1, "b", "2020-01-11", None, True),
        (2, "a", "2020-01-01", None, True)], key=repr)
    assert apply_changes(table, changes(spark, []), ["k"], ["state"], "day") and read_history(table).count() == 4


# Gold states


def lines(spark, seed, days, n=80):
    """Order lines on some days; orders 0 to 3 have lines on several days, as has each of their products."""
    pick = random.Random(seed)
    rows = []
    for _ in range(n):
        day = pick.choice(days)
        order = pick.choice([f"o{pick.randint(0, 3)}", f"o{day}-{pick.randint(0, 9)}"])
        rows.append((order, pick.choice(["anna", "ben", "cleo", None]), datetime.date(2024, 7, day), pick.choice(["cup", "jar", "pan"]),
                     pick.choice(["Name", None]), pick.randint(1, 4), pick.choice([None, *range(1, 9)])))
    return spark.createDataFrame(rows, "order_id string, customer_id string, purchase_date date, product_id string, product_name string, quantity int, price int").selectExpr(
        "*", "CAST(quantity * price AS DECIMAL(18,2)) AS line_amount")


def customers_of(df):
    return tuples(df.groupBy("customer_id").agg(F.sum("line_amount"), F.count("*")))


def test_overall_figures_come_from_daily_states(spark, tmp_path, silver):
    silver_path, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_partitions(lines(spark, 1, [1, 2, 3]), f"{silver_path}/order_lines", "purchase_date")
    silver_to_gold(spark, silver_path, gold, snapshot_date="2024-08-01")
    for seed, days in ((2, [2, 3, 4]), (2, [2, 3, 4]), (3, [5])):  # an overlapping load, the same again, a new day
        write_partitions(lines(spark, seed, days), f"{silver_path}/order_lines", "purchase_date")
        silver_to_gold(spark, silver_path, gold, snapshot_date="2024-08-01", changed_dates=[f"2024-07-0{d}" for d in days])
        now = read_table(spark, f"{silver_path}/order_lines")
        overall = read_table(spark, f"{gold}/product_revenue_overall")
        assert overall.dtypes == product_totals(now).dtypes and tuples(overall) == tuples(product_totals(now))
        assert tuples(product_totals(now)) != tuples(product_totals(now, "daily").groupBy("product_id", "product_name").agg(F.sum("revenue"), F.sum("total_quantity"), F.sum("order_count")))
        assert tuples(read_table(spark, f"{gold}/customer_revenue")) == customers_of(now)
        figures, want = read_table(spark, f"{gold}/order_kpis_current"), average_order_value(now)
        assert figures.dtypes == want.dtypes and tuples(figures) == tuples(want)
        assert tuples(read_table(spark, f"{gold}/product_revenue").where(F.day("purchase_date").isin(days)).select(*product_totals(now, "daily").columns)) == tuples(
            product_totals(now.where(F.day("purchase_date").isin(days)), "daily"))


def test_overall_figures_need_no_silver(spark, tmp_path):
    silver_path, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_partitions(lines(spark, 1, [1, 2, 3]), f"{silver_path}/order_lines", "purchase_date")
    silver_to_gold(spark, silver_path, gold)
    states = state_table(spark, gold).read()
    for df in (overall_products(states), average_order_value(order_amounts(states))):
        assert "gold/_state/days" in plan(df) and "/silver/" not in plan(df)


def test_a_load_that_comes_again_leaves_the_states(spark, tmp_path):
    silver_path, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    for seed, days, version in ((1, [1, 2, 3], 1), (2, [2, 3], 2), (2, [2, 3], 2), (3, [3], 3)):
        write_partitions(lines(spark, seed, days), f"{silver_path}/order_lines", "purchase_date")
        silver_to_gold(spark, silver_path, gold, changed_dates=[f"2024-07-0{d}" for d in days])
        states, now = state_table(spark, gold), read_table(spark, f"{silver_path}/order_lines")
        assert states.version() == version
        assert tuples(read_table(spark, f"{gold}/product_revenue_overall")) == tuples(product_totals(now))
    # one amount changes by a swap between two lines of a day: all sums of the day stay
    first, second = sorted(now.where("purchase_date = '2024-07-03' AND line_amount IS NOT NULL").select("order_id", "line_amount").distinct().collect())[:2]
    amount = F.when(F.col("order_id") == first.order_id, F.col("line_amount") + 1).when(F.col("order_id") == second.order_id, F.col("line_amount") - 1).otherwise(F.col("line_amount"))
    write_partitions(spark.createDataFrame(now.where("purchase_date = '2024-07-03'").collect(), now.schema).withColumn("line_amount", amount.cast("decimal(18,2)")), f"{silver_path}/order_lines", "purchase_date")
    silver_to_gold(spark, silver_path, gold, changed_dates=["2024-07-03"])
    now = read_table(spark, f"{silver_path}/order_lines")
    assert state_table(spark, gold).version() == 4 and tuples(read_table(spark, f"{gold}/customer_revenue")) == customers_of(now)


def test_states_are_made_with_one_shuffle_of_the_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ordermill.plans.states.TASK_ROWS", 10)
    write_partitions(lines(spark, 1, [1, 2, 3]), str(tmp_path / "silver"), "purchase_date")
    silver = read_table(spark, str(tmp_path / "silver"))
    made = daily_states(silver, [27, 27, 26])
    assert plan(made).count("hashpartitioning(") == 1
    totals = made.where("kind = 'product'").select("revenue", F.col("quantity").alias("total_quantity"), F.col("orders").alias("order_count"), "purchase_date", "product_id", "product_name")
    want = product_totals(silver, "daily")
    assert tuples(totals, *want.columns) == tuples(want)
    states = state_table(spark, str(tmp_path))
    states.replace(made, [], gather=False)
    assert tuples(overall_products(states.read(), str(tmp_path / "spread"))) == tuples(overall_products(states.read())) == tuples(product_totals(silver))


def test_dates_that_silver_lost_are_taken_out(spark, tmp_path):
    import shutil

    silver_path, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_partitions(lines(spark, 1, [1, 2, 3]), f"{silver_path}/order_lines", "purchase_date")
    silver_to_gold(spark, silver_path, gold)
    shutil.rmtree(f"{silver_path}/order_lines/purchase_date=2024-07-02")
    silver_to_gold(spark, silver_path, gold, changed_dates=[])
    now = read_table(spark, f"{silver_path}/order_lines")
    assert tuples(read_table(spark, f"{gold}/product_revenue_overall")) == tuples(product_totals(now))
    assert tuples(read_table(spark, f"{gold}/customer_revenue")) == customers_of(now)


def test_customer_totals_catch_up_and_count_once(spark, tmp_path):
    states, totals = state_table(spark, str(tmp_path)), VersionedTable(spark, str(tmp_path / "totals"))
    assert update_customer_totals(states, totals) is None
    shown = lambda: tuples(totals.read().select("customer_id", "revenue", "lines"))
    one, two = lines(spark, 1, [1, 2]), lines(spark, 2, [2, 3])
    states.replace(daily_states(one), [])
    assert update_customer_totals(states, totals) == 1 == update_customer_totals(states, totals) and shown() == customers_of(one)
    states.replace(daily_states(two), [])
    states.replace(daily_states(two), [])  # the totals missed one version: a load stopped in between, and ran again
    update_customer_totals(states, totals)
    assert shown() == customers_of(one.where("purchase_date <> '2024-07-02'").union(two))
    went, came = states.changes(2)
    assert {str(r[0]) for r in came.select("purchase_date").distinct().collect()} == {"2024-07-02", "2024-07-03"}
    states.replace(daily_states(two), ["2024-07-01", "2024-07-02", "2024-07-03"])
    states.vacuum(1)  # what the totals follow is gone: they are made anew
    update_customer_totals(states, totals)
    assert shown() == customers_of(two)
