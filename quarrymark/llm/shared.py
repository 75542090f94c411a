"""Session helpers of the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; unset on a cluster is an error, and locally gives a temporary one."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = os.path.join(tempfile.gettempdir(), "quarrymark-checkpoints")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver delete a folder, which is there by now, when it ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends there, and lost executors cost nothing.

    tasks: so many write it, and so many files it has, where that is fewer than there are partitions.
    """
    path = new_path(df.sparkSession, name)
    (df if tasks is None or tasks >= partitions(df.sparkSession) else df.coalesce(tasks)).write.parquet(path)
    delete_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: sizes of groups follow from it."""
    return int(df.agg(F.sum(F.octet_length(F.col(column)).cast("long"))).first()[0] or 0)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


WHOLE = ("tinyint", "smallint", "int", "bigint")


def whole_ids(df: DataFrame, column: str = "doc_id") -> Column:
    """The ids as longs; those of another type than whole numbers are an error, not nulls."""
    kind = dict(df.dtypes)[column]
    if kind not in WHOLE and kind != "void":
        raise TypeError(f"{column} has to be a whole number, not {kind}")
    return F.col(column).cast("long")


def given_ids(rows: pa.Table) -> pa.Array:
    """doc_id of rows in Arrow, null where `unknown`."""
    return pa.array(rows["doc_id"].to_numpy(), pa.int64(), mask=rows["unknown"].to_numpy())


def salted_join(rows: DataFrame, table: DataFrame, key: str, salt: Column, salts: int) -> DataFrame:
    """rows with the columns of their key's row in table, left outer; a hot key is dealt over so many salts.

    table has a row for each key at most. Only salts that a key has among the rows are given to its row,
    so that nothing is copied for rare keys.
    """
    dealt = unused(rows, "_salt")
    salted = rows.withColumn(dealt, F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
    seen = salted.groupBy(key).agg(F.collect_set(dealt).alias("_salts"))
    spread = table.join(seen, key).select("*", F.explode("_salts").alias(dealt)).drop("_salts")
    return salted.join(spread, [key, dealt], "left").drop(dealt)


def numbered(rows: DataFrame, key: str, name: str = "src") -> DataFrame:
    """rows with their place in the order of a unique key, from 0: places within sorted partitions, and the partitions' sizes."""
    placed = written(rows.orderBy(key).withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", 33)
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())  # one for each partition
    before, base = {}, 0
    for p, n in counts:
        before[p], base = base, base + n
    if not counts:
        return placed.withColumn(name, F.lit(0).cast("long")).drop("_at")
    start = F.create_map(*(F.lit(int(x)).cast("long") for kv in before.items() for x in kv))
    return placed.withColumn(name, F.try_element_at(start, part.cast("long")) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at")


def hash_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """Rows whose key's hash falls in so small a share that about `most` of them are expected at most; all, if they are no more.

    No rows meet in one task for it, as they would for the first ones in some order.
    """
    n = rows.count()
    if n <= most:
        return rows
    return rows.filter(F.pmod(F.xxhash64(F.col(key), F.lit(most)), F.lit(1 << 40)) < F.lit(int((1 << 40) * (most / n))))
