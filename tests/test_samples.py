from pyspark.sql import functions as F

from ludolens import samples


def _tables(spark, folder):
    lines = spark.range(400).select(
        (F.col("id") % 150).alias("l_orderkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        F.when(F.col("id") % 50 != 0, F.col("id") % 30).alias("l_partkey"),
        (F.col("id") % 9).alias("l_suppkey"),
        F.lit(1.0).alias("l_quantity"),
        F.lit(0.1).alias("l_discount"),
        F.lit(0.0).alias("l_tax"),
        F.lit("A").alias("l_returnflag"),
        F.lit("2020-01-02").cast("timestamp").alias("l_shipdate"),
        F.lit(5.5).alias("l_extendedprice"),
    )
    parts = spark.range(25).select(
        F.col("id").alias("p_partkey"),
        F.lit("red car").alias("p_name"),
        F.lit("b").alias("p_brand"),
        F.lit("t").alias("p_type"),
        (F.col("id") % 6).cast("int").alias("p_size"),
        F.lit(2.5).alias("p_retailprice"),
    )
    for name, df in (("lineitem", lines), ("part", parts)):
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_a_task_takes_a_bounded_number_of_rows(spark, tmp_path, monkeypatch, rows):
    _tables(spark, tmp_path)
    lines = samples.table(spark, str(tmp_path), "lineitem")
    whole = rows(samples.raw_games(spark, str(tmp_path)))
    assert samples.spread(lines, "l_orderkey").rdd.getNumPartitions() == 4
    monkeypatch.setattr(samples, "ROWS_PER_TASK", 40)
    assert samples.spread(lines, "l_orderkey").rdd.getNumPartitions() == 10
    assert rows(samples.raw_games(spark, str(tmp_path))) == whole


def test_many_parts_are_not_broadcast(spark, tmp_path, monkeypatch, rows):
    _tables(spark, tmp_path)
    whole = rows(samples.raw_games(spark, str(tmp_path)))
    monkeypatch.setattr(samples, "_FEW_PARTS", 10)
    monkeypatch.setattr(samples, "ROWS_PER_TASK", 40)
    games = samples.raw_games(spark, str(tmp_path))
    plan = games._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and plan.count("Exchange") == 2
    assert rows(games) == whole and len(whole) > 300
