import uuid

import pytest
from pyspark.sql import functions as F

from gridlake.operators.joins import HOUR_KEYS, attach_prices
from gridlake.operators.quality import Contract
from gridlake.operators.reshape import pivot_generation
from gridlake.sinks.buckets import write_buckets
from gridlake.sinks.checked import publish_checked
from testbed import derive

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.fixture
def sort_merge(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("month_of", [None, "date"])
def test_bucketed_tables_are_pivoted_and_joined_without_a_shuffle(spark, rows, tmp_path, sort_merge, month_of):
    names = []
    for kind, df in (("gen", derive.generation(spark, SF)), ("prices", derive.prices(spark, SF))):
        names.append(f"{kind}_{uuid.uuid4().hex}")
        write_buckets(df, names[-1], f"{tmp_path}/{kind}", 4, month_of=month_of)
    gen, prices = (spark.table(n) for n in names)
    got = attach_prices(pivot_generation(gen, scale=2), prices, "full")
    plain = attach_prices(pivot_generation(derive.generation(spark, SF), scale=2), derive.prices(spark, SF), "full")
    assert "Exchange" in plan(plain) and "Exchange" not in plan(got)
    assert rows(got, *plain.columns) == rows(plain)


def test_a_bucket_is_one_file_and_writing_again_replaces_all(spark, tmp_path):
    name, prices = f"prices_{uuid.uuid4().hex}", derive.prices(spark, SF)
    write_buckets(prices, name, f"{tmp_path}/p", 4, month_of="date")
    assert len(list(tmp_path.glob("p/month=*/*.parquet"))) == 4
    moved = prices.where(F.col("zone") == "1").withColumn("date", F.date_add("date", 31))
    write_buckets(moved, name, f"{tmp_path}/p", 4, month_of="date")
    assert spark.table(name).count() == moved.count() > 0
    assert sorted(r.month.month for r in spark.table(name).select("month").distinct().collect()) == [2, 3]


CONTRACT = Contract(not_null=("k",), unique=("k",), accepted_range={"v": (0, 9)})


def build(spark, tmp_path, name, data, **layout):
    return publish_checked(spark.createDataFrame(data, "k string, v int"), name, str(tmp_path), CONTRACT, **layout)


@pytest.mark.parametrize("layout", [{}, {"cluster": ["k"]}, {"partition": ["v"]}])
def test_a_bad_build_leaves_the_former_one(spark, rows, tmp_path, layout):
    name = f"mart_{uuid.uuid4().hex}"
    good = build(spark, tmp_path, name, [("a", 1), ("b", 2)], **layout)
    assert good.published and good.n_rows == 2 and rows(spark.table(name), "k", "v") == [("a", 1), ("b", 2)]
    bad = build(spark, tmp_path, name, [("a", 1), ("a", 10), (None, 3), (None, None)], **layout)
    assert not bad.published and bad.n_rows == 4
    assert bad.failures == {"not_null:k": 2, "accepted_range:v": 1, "unique:k": 1}
    assert rows(spark.table(name), "k", "v") == [("a", 1), ("b", 2)]
    assert build(spark, tmp_path, name, [("c", 3)], **layout).published
    assert rows(spark.table(name), "k", "v") == [("c", 3)]


def test_a_first_bad_build_gives_no_table_and_an_empty_one_does(spark, tmp_path):
    name = f"mart_{uuid.uuid4().hex}"
    assert not build(spark, tmp_path, name, [("a", -1)]).published
    assert not spark.catalog.tableExists(name)
    empty = publish_checked(spark.createDataFrame([], "k string, v int"), name, str(tmp_path), CONTRACT)
    assert empty.published and empty.n_rows == 0 and spark.table(name).count() == 0
