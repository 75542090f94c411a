"""A pool of rows that are unique by key, with its keys beside it in buckets, so that appending reads the buckets of new keys and not the pool.

    rows/append=ID     the rows of an append
    keys/append=ID     their keys, in folders of a bucket each (the first bits of a hash)
    commits            a line for each append that counts: what a failed one left is read by nobody

Buckets are kept at a size: when they have grown past it, all keys are written again in more of them, so what an append reads depends on
its own rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT = "id string, n bigint, bits int, keys array<string>, place bigint"
#: Keys of a bucket, on average, past which buckets are split.
BUCKET_KEYS = 200_000


def _there(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


class KeyedPool:
    """path: of the pool; key: its rows' string or number that is unique; kind: the rows' columns, as DDL."""

    def __init__(self, spark: SparkSession, path: str, key: str, kind: str, bucket_keys: int = BUCKET_KEYS) -> None:
        self.spark, self.path, self.key, self.kind, self.bucket_keys = spark, path.rstrip("/"), key, kind, bucket_keys

    def commits(self) -> list:
        """A row for each append, oldest first."""
        where = f"{self.path}/commits"
        return sorted(self.spark.read.schema(COMMIT).json(where).collect(), key=lambda c: c["place"]) if _there(self.spark, where) else []

    def _commit(self, own: str, n: int, bits: int, keys: list[str], place: int) -> None:
        self.spark.createDataFrame([(own, n, bits, keys, place)], COMMIT).coalesce(1).write.mode("append").json(f"{self.path}/commits")

    def rows(self) -> DataFrame:
        """The pool."""
        ids = [c["id"] for c in self.commits() if c["n"]]
        if not ids:
            return self.spark.createDataFrame([], self.kind)
        return self.spark.read.schema(self.kind).parquet(*(f"{self.path}/rows/append={i}" for i in ids))

    def _bucket(self, bits: int) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.col(self.key)), 64 - bits).cast("int") if bits else F.lit(0)

    def _keys(self, ids: list[str]) -> DataFrame:
        rows = self.spark.read.option("basePath", f"{self.path}/keys")
        kind = f"{self._key_kind()}, append string, bucket int"
        return rows.schema(kind).parquet(*(f"{self.path}/keys/append={i}" for i in ids)) if ids else self.spark.createDataFrame([], kind)

    def _key_kind(self) -> str:
        found = next(f for f in self.spark.createDataFrame([], self.kind).dtypes if f[0] == self.key)
        return f"`{found[0]}` {found[1]}"

    def held(self, rows: DataFrame) -> DataFrame:
        """Keys of rows that the pool holds. Only the folders of their buckets are read: they are pruned when the buckets are known."""
        at = self.commits()
        if not at:
            return self.spark.createDataFrame([], self._key_kind())
        wanted = rows.select(self.key).filter(F.col(self.key).isNotNull()).distinct().withColumn("bucket", self._bucket(at[-1]["bits"]))
        touched = F.broadcast(wanted.select("bucket").distinct())  # no more rows than there are buckets
        return self._keys(at[-1]["keys"]).join(touched, "bucket").join(wanted, ["bucket", self.key], "left_semi").select(self.key)

    def append(self, rows: DataFrame, *order: str) -> int:
        """Add rows whose key the pool doesn't hold, one for each key, the first by `order`; how many. Rows without a key aren't added.

        An append that fails leaves the pool as it was. Two at once aren't supported.
        """
        from ..operators.sampling import first_per

        at = self.commits()
        bits, keys, total = (at[-1]["bits"], list(at[-1]["keys"]), sum(c["n"] for c in at)) if at else (0, [], 0)
        own = uuid.uuid4().hex
        columns = self.spark.createDataFrame([], self.kind).columns
        some = rows.filter(F.col(self.key).isNotNull())
        new = first_per(some, self.key, *(order or [c for c in columns if c != self.key])).join(self.held(some), self.key, "left_anti")
        new.select(*columns).write.parquet(f"{self.path}/rows/append={own}")
        added = self.spark.read.schema(self.kind).parquet(f"{self.path}/rows/append={own}")
        n = added.count()
        if not n:
            return 0
        self._write_keys(added.select(self.key), own, bits)
        keys.append(own)
        if (total + n) > self.bucket_keys << bits or len(keys) > 64:  # split buckets, and join what many small appends left
            while (total + n) > self.bucket_keys << bits:
                bits += 1
            merged = uuid.uuid4().hex
            self._write_keys(self._keys(keys).select(self.key), merged, bits)
            keys = [merged]
        self._commit(own, n, bits, keys, len(at))
        return n

    def _write_keys(self, keys: DataFrame, own: str, bits: int) -> None:
        keys.withColumn("bucket", self._bucket(bits)).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/keys/append={own}")
