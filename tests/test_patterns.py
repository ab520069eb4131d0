from pyspark.sql import Window
from pyspark.sql import functions as F

from dimwright.operators.keys import assign_keys
from dimwright.operators.patterns import anti_join, insert_missing, supersede, update_from
from tests.conftest import rows


def test_update_writes_null_when_matched(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    s = spark.createDataFrame([(1, None), (2, "B")], "k long, v string")
    out = update_from(t, s, [("k", "k")], {"v": F.col("s.v")})
    assert rows(out) == [(1, None), (2, "B"), (3, "c")]


def test_update_duplicate_sources_keep_row_count(spark):
    t = spark.createDataFrame([(1, "a")], "k long, v string")
    s = spark.createDataFrame([(1, "z"), (1, "y")], "k long, v string")
    out = update_from(t, s, [("k", "k")], {"v": F.col("s.v")})
    assert rows(out) == [(1, "y")]  # smallest source row wins, stated choice


def test_update_where_null_is_false(spark):
    t = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k long, v string, e string")
    s = spark.createDataFrame([(1, "A", "q"), (2, "B", "x")], "k long, v string, e string")
    # `!=` never holds against a null, so row 1 keeps its value
    out = update_from(t, s, [("k", "k")], {"v": F.col("s.v")}, where=F.col("t.e") != F.col("s.e"))
    assert rows(out, "k", "v") == [(1, "a"), (2, "b")]


def test_anti_join_variants(spark):
    c = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    e = spark.createDataFrame([("a",)], "x string")
    e_null = spark.createDataFrame([("a",), (None,)], "x string")
    assert rows(anti_join(c, e, ["x"])) == [("b",), (None,)]           # LEFT JOIN .. IS NULL
    assert rows(anti_join(c, e, ["x"], null_aware=True)) == [("b",)]   # NOT IN: null candidate dropped
    assert rows(anti_join(c, e_null, ["x"], null_aware=True)) == []    # NOT IN: one null blocks all
    assert rows(anti_join(c, e_null, ["x"], null_safe=True)) == [("b",)]


def test_insert_missing_continues_keys(spark):
    dim = spark.createDataFrame([(7, "x")], "id long, name string")
    cand = spark.createDataFrame([("z",), ("x",), ("b",)], "name string")
    out = insert_missing(dim, cand, ["name"], "id", order_by=["name"])
    assert rows(out, "id", "name") == [(7, "x"), (8, "b"), (9, "z")]


def test_insert_missing_empty_dim_starts_at_one(spark):
    dim = spark.createDataFrame([], "id long, name string")
    cand = spark.createDataFrame([("q",), ("p",)], "name string")
    assert rows(insert_missing(dim, cand, ["name"], "id"), "id", "name") == [(1, "p"), (2, "q")]


def test_assign_keys_equals_global_row_number(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(13)
    out = assign_keys(df, ["k"], "key", base=100, num_partitions=9)   # force the two-pass path
    got = rows(out, "k", "key")
    assert got == [(k, 100 + k + 1) for k in range(1000)]


def test_assign_keys_plan_has_no_single_partition_exchange(spark):
    df = spark.range(0, 100).select(F.col("id").alias("k"))
    out = assign_keys(df, ["k"], "key")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step is the per-partition offset table inside the broadcast
    b, single = plan.find("BroadcastExchange"), plan.find("SinglePartition")
    assert b != -1 and (single == -1 or single > b)


def test_supersede_restamps_all_versions(spark):
    fact = spark.createDataFrame([("A", True, 1), ("A", False, 2), ("B", True, 3)], "k string, is_active boolean, d int")
    fact = fact.withColumn("date_updated", F.lit(None).cast("timestamp_ntz"))
    stage = spark.createDataFrame([("A",), ("A",)], "k string")
    out = supersede(fact, stage, ["k"], "2024-01-01 00:00:00")
    got = rows(out, "k", "d", "is_active", F.col("date_updated").isNotNull())
    assert got == [("A", 1, False, True), ("A", 2, False, True), ("B", 3, True, False)]


def test_assign_keys_equals_one_ordered_window(spark):
    df = spark.range(0, 500).select((F.col("id") * 31 % 500).cast("string").alias("k"))
    small = rows(df.withColumn("key", 7 + F.row_number().over(Window.orderBy("k"))), "k", "key")
    big = rows(assign_keys(df, ["k"], "key", base=7), "k", "key")
    assert small == big
