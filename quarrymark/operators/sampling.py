"""First rows, caps, quotas, samples and splits. Every order is total and every draw a hash, so results repeat anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import reference_data as R


def unused(name: str, *frames: DataFrame) -> str:
    """name, with underscores behind it until no column of the frames has it."""
    taken = {c.lower() for rows in frames for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hash_rank(*keys: Column | str, seed: str = "42") -> Column:
    """An order that looks random: md5 of the seed and the keys."""
    return F.md5(F.concat_ws("|", F.lit(seed), *keys))


def first_per(rows: DataFrame, key: Column | str, *order: Column | str) -> DataFrame:
    """The first row of each key."""
    return capped(rows, key, 1, *order)


def capped(rows: DataFrame, key: Column | str, most: int | Column, *order: Column | str, ceiling: int | None = None) -> DataFrame:
    """At most so many rows of each key, in order.

    A literal limit is pushed below the shuffle as a group limit, so that a hot key sends few rows; with a limit per key,
    `ceiling` (the greatest of them) does the same.
    """
    name = unused("_rank", rows)
    ranked = rows.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    if ceiling is not None:
        ranked = ranked.filter(F.col(name) <= ceiling)
    return ranked.filter(F.col(name) <= most).drop(name)


def type_targets(total: int, floor: int = 50, weights: dict[str, int] = R.TYPE_WEIGHTS) -> list[tuple[str, int]]:
    whole = sum(weights.values())
    return [(k, max(floor, total * w // whole)) for k, w in weights.items()]


def sampled_to_targets(rows: DataFrame, kind: str, total: int, *keys: str, seed: str = "42", oversample: int = 1, unknown: int = 0, floor: int = 50) -> DataFrame:
    """Rows of each type up to its target times oversample, by hash rank; of other types `unknown` rows each."""
    target = unused("_target", rows)
    targets = rows.sparkSession.createDataFrame(type_targets(total, floor), f"{kind} string, {target} int")
    ranked = rows.join(F.broadcast(targets), kind, "left")  # a row for each of the configured types
    most = F.coalesce(F.col(target) * oversample, F.lit(unknown))
    ceiling = max(unknown, *(n * oversample for _, n in type_targets(total, floor)))
    return capped(ranked, kind, most, hash_rank(*keys, seed=seed), *keys, ceiling=ceiling).drop(target)


def hash_sample(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """Rows whose key's hash falls in the first percents; the same in any engine with md5."""
    return rows.filter(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 4), 16, 10).cast("bigint") % 100 < percent)


def _ranked(rows: DataFrame, bucket: Column, order: list[Column | str], kind: str | None = None) -> DataFrame:
    """rows with unused("_rank", rows) from 1 (within kind) and unused("_all", rows), rows of the kind, for a bucket that ascends with the order.

    Ranks within buckets are windows of one bucket each; the sizes of the buckets before are added from a small table.
    """
    keys = [kind] if kind else []
    b, size, r, ahead, rank, whole = (unused(c, rows) for c in ("_b", "_n", "_r", "_before", "_rank", "_all"))
    dealt = rows.withColumn(b, bucket)
    sizes = dealt.groupBy(*keys, b).agg(F.count("*").alias(size))
    w = Window.partitionBy(*keys)
    before = sizes.select(*keys, b, F.coalesce(F.sum(size).over(w.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(ahead), F.sum(size).over(w).alias(whole))
    own = dealt.withColumn(r, F.row_number().over(Window.partitionBy(*keys, b).orderBy(*order)))
    if kind:
        same = own[kind].eqNullSafe(before[kind]) & (own[b] == before[b])
        own = own.join(before, same).drop(before[kind]).drop(before[b])
    else:
        own = own.join(F.broadcast(before), b)  # a row for each of a bounded number of buckets
    return own.withColumn(rank, F.col(ahead) + F.col(r)).drop(b, r, ahead)


def split(rows: DataFrame, *keys: str, share: float = 0.9, seed: str = "42", kind: str | None = None) -> DataFrame:
    """rows with split "train" or "eval": exactly floor(n * share) train rows by hash rank; within each kind, if given, and
    one of each at least. Hash buckets (4096) keep a hot kind from being one task. A column split of rows is replaced."""
    h, rank, whole = (unused(c, rows) for c in ("_h", "_rank", "_all"))
    ranked = _ranked(rows.withColumn(h, hash_rank(*keys, seed=seed)), F.substring(h, 1, 3), [h, *keys], kind)
    most = F.floor(F.col(whole) * share)
    train = F.col(rank) <= (F.greatest(F.lit(1), most) if kind else most)
    return ranked.withColumn("split", F.when(train, "train").otherwise("eval")).drop(h, rank, whole)


def stratified_split(rows: DataFrame, kind: str, *keys: str, share: float = 0.9, seed: str = "42") -> DataFrame:
    return split(rows, *keys, share=share, seed=seed, kind=kind)


def placed(rows: DataFrame, rank: str) -> DataFrame:
    """rows with place from 1 in the order of a hex hash; a column place of rows is replaced."""
    at, whole = unused("_rank", rows), unused("_all", rows)
    return _ranked(rows, F.substring(rank, 1, 3), [rank]).withColumn("place", F.col(at)).drop(at, whole)


def ordered_ranks(rows: DataFrame, order: str, buckets: int = 256) -> DataFrame:
    """rows with a rank from 1 in the order of a numeric column, and how many there are, named as by _ranked(); approximate quantiles cut the range in buckets."""
    cuts = rows.agg(F.percentile_approx(order, F.array(*(F.lit(i / buckets) for i in range(1, buckets))))).first()[0] or []
    bucket = F.size(F.filter(F.array(*(F.lit(c) for c in sorted(set(cuts)))), lambda c: c < F.col(order))) if cuts else F.lit(0)
    return _ranked(rows, bucket, [order])


def numbered(rows: DataFrame, order: str, pattern: str = "train_%06d") -> DataFrame:
    """rows with id, made of their place in the order; a column id of rows is replaced."""
    rank, whole = unused("_rank", rows), unused("_all", rows)
    return ordered_ranks(rows, order).withColumn("id", F.format_string(pattern, F.col(rank) - 1)).drop(rank, whole)


def chunked(rows: DataFrame, order: str, size: int, chunks: int) -> DataFrame:
    """rows with batch (of `size` rows) and chunk (of `chunks` nearly equal ones, larger ones first)."""
    whole = F.col(unused("_all", rows))
    r, small, large = F.col(unused("_rank", rows)) - 1, F.floor(whole / chunks), whole % chunks
    early = (small + 1) * large
    chunk = F.when(r < early, F.floor(r / (small + 1))).otherwise(large + F.floor((r - early) / F.greatest(small, F.lit(1)))) + 1
    return ordered_ranks(rows, order).select(*rows.columns, F.floor(r / size).cast("long").alias("batch"), chunk.cast("long").alias("chunk"))


def without(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't known yet: append-only pools and runs that go on."""
    return rows.join(known.select(key).distinct(), key, "left_anti")


def merged_pools(first: DataFrame, *others: DataFrame, key: str, order: str) -> DataFrame:
    """All rows, once per key; earlier pools win."""
    pool = unused("_pool", first, *others)
    out = first.withColumn(pool, F.lit(0))
    for k, rows in enumerate(others, 1):
        out = out.unionByName(rows.withColumn(pool, F.lit(k)), allowMissingColumns=True)
    return first_per(out, key, pool, order).drop(pool)


def derived_urls(domains: DataFrame, paths: list[str], known: DataFrame, most: int) -> DataFrame:
    """https URLs of the first `most` domains with each path, but for known ones."""
    some = domains.select("domain").distinct().orderBy("domain").limit(most)
    urls = some.select(F.explode(F.array(*(F.concat(F.lit("https://"), "domain", F.lit(p)) for p in paths))).alias("url"))
    return without(urls, known, "url")
