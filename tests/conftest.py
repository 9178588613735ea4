import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.appName("ordermill-tests").master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def raw(spark):
    from ordermill.schemas import RAW_ORDERS

    def item(product_id, name, quantity, price):
        return {"product_id": product_id, "name": name, "quantity": quantity, "price": price}

    cup = ("cup", "  Cup, blue ")
    return spark.createDataFrame(
        [
            ("R-10", "anna", "2024/7/3 10:15", [item(*cup, "12,0", "3,05"), item(*cup, "a dozen", "3.05"), item("jar", "  ", " -2", "1.2.3")]),
            ("R-11", "ben", "2024-07-04", []),
            ("R-12", "anna", "4 July", [item("jar", "Jar", "0", ".5")]),
            ("R-13", None, None, None),
        ],
        RAW_ORDERS,
    )


@pytest.fixture
def silver(spark):
    """Three days, three customers, three products; one product under two names, one line without an amount, two equal revenues."""
    return spark.sql("""
        SELECT order_id, customer_id, CAST(day AS DATE) AS purchase_date, product_id, product_name, quantity, price,
               CAST(quantity * price AS DECIMAL(18,2)) AS line_amount
        FROM VALUES
          ('s1', 'anna', '2024-07-01', 'cup', 'Cup', 4, 2.50BD), ('s1', 'anna', '2024-07-01', 'jar', 'Jar', 1, 10.00BD),
          ('s2', 'ben', '2024-07-02', 'cup', 'Cup', 2, 2.50BD), ('s2', 'ben', '2024-07-02', 'pan', 'Pan', 1, null),
          ('s3', 'cleo', '2024-07-04', 'cup', 'Blue cup', 1, 3.10BD), ('s3', 'cleo', '2024-07-04', 'jar', 'Jar', 3, 0.40BD)
        AS t(order_id, customer_id, day, product_id, product_name, quantity, price)""")


def tuples(df, *columns):
    return sorted((tuple(row) for row in (df.select(*columns) if columns else df).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
