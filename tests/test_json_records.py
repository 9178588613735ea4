"""Large JSON arrays read by many tasks, against Spark's own reader."""

import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from ordermill.schemas import CORRUPT, RAW_ORDERS
from ordermill.sources import read_json_records, read_raw_orders
from tests.conftest import tuples

SCHEMA = T.StructType([*RAW_ORDERS.fields, T.StructField(CORRUPT, T.StringType())])
ODD = ["plain", "a } b", "{[", '"quoted"', "back\\slash", "end\\", '\\"}', "é 日本 🙂", "tab\t\n}", "", "]}", ',{"order_id":"fake"}']


def order(pick, k):
    odd = pick.choice(ODD)
    lines = [{"product_id": f"p{j}", "name": odd, "quantity": "1", "price": "2,0"} for j in range(pick.randint(0, 3))]
    return {"order_id": f"o{k} {odd}", "customer_id": odd, "purchase_date": " 2024-01-01", "products": lines}


@pytest.fixture(scope="module")
def orders():
    pick = random.Random(1)
    return [order(pick, k) for k in range(150)]


@pytest.fixture
def splits(settings):
    def change(size):
        settings(spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="0")

    return change


def own(spark, path):
    return tuples(spark.read.schema(SCHEMA).json(str(path), multiLine=True))


@pytest.mark.parametrize("size", [97, 1 << 27])
def test_rows_are_those_of_sparks_reader(spark, orders, tmp_path, splits, size):
    texts = [json.dumps(orders, indent=2), json.dumps(orders[:40], ensure_ascii=False), json.dumps(orders[2], indent=1), "[]", "[ ]\n",
             "﻿ " + json.dumps(orders[5:9]) + "\n\n", json.dumps([orders[7]]), " " + json.dumps({}), "[{}, {}]", json.dumps(orders[3:5], indent="\t").replace("\n", "\r\n")]
    for k, text in enumerate(texts):
        (tmp_path / f"{k}.json").write_text(text, encoding="utf-8", newline="")
    splits(size)
    got = read_json_records(spark, str(tmp_path), SCHEMA)
    assert got.schema.names == SCHEMA.names
    assert tuples(got) == own(spark, tmp_path)


def test_one_file_is_many_tasks(spark, orders, tmp_path, splits):
    (tmp_path / "a.json").write_text(json.dumps(orders * 20))
    size = (tmp_path / "a.json").stat().st_size
    splits(size // 9)
    from ordermill.sources.json_records import _fragments

    parts = _fragments(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).groupBy("block").agg(F.count("*").alias("n"), F.countDistinct("task").alias("tasks")).collect()
    assert len(parts) >= 9 and all(r.tasks == 1 for r in parts) and max(r.n for r in parts) < 1.3 * sum(r.n for r in parts) / len(parts)
    assert spark.read.schema(SCHEMA).json(str(tmp_path), multiLine=True).rdd.getNumPartitions() == 1
    assert tuples(read_json_records(spark, str(tmp_path), SCHEMA)) == own(spark, tmp_path)


@pytest.mark.parametrize("size", [150, 1 << 27])
def test_broken_records_stay_apart(spark, orders, tmp_path, splits, size):
    good = [json.dumps(o) for o in orders[:30]]
    broken = ['{"order_id": "x", "products": }', '{"order_id": x}', '{"order_id": {"n": 1}, "products": [{"a"}]}']
    (tmp_path / "a.json").write_text("[" + ",\n".join(good[:10] + broken[:1] + good[10:20] + broken[1:] + good[20:]) + "]")
    splits(size)
    rows = read_json_records(spark, str(tmp_path), SCHEMA).collect()
    assert sorted(r[CORRUPT] for r in rows if r[CORRUPT]) == sorted(broken)
    assert sorted(r.order_id for r in rows if not r[CORRUPT]) == sorted(o["order_id"] for o in orders[:30])


@pytest.mark.parametrize("size", [150])
@pytest.mark.parametrize("text", ["not json", '{"order_id": "a"', '[{"order_id": "a"}, {"order_id": "b"', '{"order_id": "a"}}', '[1, {"order_id": "a"}]', '"text"'])
def test_nothing_is_lost_of_broken_files(spark, tmp_path, splits, size, text):
    (tmp_path / "a.json").write_text(text)
    splits(size)
    rows = read_json_records(spark, str(tmp_path), SCHEMA).collect()
    assert any(r[CORRUPT] for r in rows) or '}}' in text
    assert all(r[CORRUPT] or r.order_id == "a" for r in rows)


@pytest.mark.parametrize("size", [200, 1 << 27])
def test_unbalanced_brackets_set_the_rest_aside_split_by_split(spark, orders, tmp_path, splits, size):
    good = [json.dumps(o) for o in orders[:40] if not any(c in o["customer_id"] for c in '{}[]')]
    (tmp_path / "a.json").write_text("[" + ",\n".join(good[:9] + ['{"order_id": "x", "products": [{']) + ",\n" + ",\n".join(good[9:]) + "]")
    (tmp_path / "b.json").write_text("[" + good[0] + "]")
    splits(size)
    rows = read_json_records(spark, str(tmp_path), SCHEMA).collect()
    assert sum(r[CORRUPT] is None for r in rows) >= 10
    left = "".join(r[CORRUPT] for r in rows if r[CORRUPT])
    assert all(json.loads(g)["order_id"] in {r.order_id for r in rows} for g in good[:9])
    assert sum(g.count('"order_id"') for g in good[9:]) <= left.count('"order_id"') + sum(r[CORRUPT] is None for r in rows)


def test_compressed_files_and_several_objects(spark, orders, tmp_path, splits):
    import gzip

    (tmp_path / "a.json.gz").write_bytes(gzip.compress(json.dumps(orders[:20]).encode()))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(o) for o in orders[20:50]))
    splits(300)
    assert sorted(r.order_id for r in read_json_records(spark, str(tmp_path), SCHEMA).collect()) == sorted(o["order_id"] for o in orders[:50])


def test_one_record_over_many_splits(spark, tmp_path, splits):
    big = {"order_id": "big", "products": [{"product_id": f"p{k}", "name": "}" * (k % 5)} for k in range(400)]}
    (tmp_path / "a.json").write_text(json.dumps([{"order_id": "before"}, big, {"order_id": "after"}]))
    splits(500)
    rows = {r.order_id: r for r in read_raw_orders(spark, str(tmp_path)).collect()}
    assert set(rows) == {"before", "big", "after"} and len(rows["big"].products) == 400


def test_one_task_reader_is_still_there(spark, orders, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(orders))
    assert tuples(read_raw_orders(spark, str(tmp_path), split=False)) == tuples(read_raw_orders(spark, str(tmp_path)))
