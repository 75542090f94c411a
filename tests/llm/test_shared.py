from pyspark.sql import functions as F

from quarrymark.llm import shared as S


def test_salted_join_is_a_left_join(spark):
    rows = spark.range(500).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"), F.col("id").alias("v"))
    table = rows.filter("key IS NOT NULL").groupBy("key").agg(F.sum("v").alias("total")).filter("key <> 'k2'")
    got = sorted(map(tuple, S.salted_join(rows, table, "key", F.col("v"), 7).select("key", "v", "total").collect()), key=str)
    assert got == sorted(map(tuple, rows.join(table, "key", "left").select("key", "v", "total").collect()), key=str)


def test_hash_sample(spark):
    rows = spark.range(5000)
    assert S.hash_sample(rows, "id", 6000).count() == 5000
    some = S.hash_sample(rows, "id", 1000)
    assert 800 < some.count() < 1200
    assert {r.id for r in some.collect()} == {r.id for r in S.hash_sample(rows.repartition(7), "id", 1000).collect()}
    assert S.hash_sample(rows.filter("false"), "id", 10).count() == 0


def test_written_tables(spark):
    rows = spark.range(100).repartition(4).select("id", F.lit("x").alias("s"))
    back = S.written(rows, "t", 1)
    assert back.count() == 100 and back.columns == ["id", "s"] and back.rdd.getNumPartitions() <= 2
    assert S.text_bytes(spark.createDataFrame([("é",), (None,)], "text string")) == 2 and S.text_bytes(spark.createDataFrame([], "text string")) == 0
    assert S.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
