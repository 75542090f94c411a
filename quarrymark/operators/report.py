"""Counts, shares, distributions and costs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Token prices per million and GPU prices per hour of a cost model; all are parameters.
TOKEN_PRICE = {"input": 0.15, "output": 0.60}
GPU_HOUR, PAGE_SECONDS = 0.89, 1.44


def frequencies(rows: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """key and n; the most frequent ones, ties by key."""
    out = rows.groupBy(key).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), key).limit(most) if most else out


def shares(counts: DataFrame) -> DataFrame:
    """Counts with their percentage of all (null where all are 0); a total of a grouped table, not of rows."""
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share", F.round(F.try_divide(100.0 * F.col("n"), total), 6).cast("double"))


def have_and_want(have: DataFrame, want: DataFrame, key: str) -> DataFrame:
    """Full join of counts with targets: OK from four times the target, LOW from the target, else CRITICAL."""
    zero = F.lit(0).cast("long")
    both = have.join(want, key, "full").select(key, F.coalesce("n", zero).alias("have"), F.coalesce("want", zero).alias("want"))
    return both.withColumn("status", F.when(F.col("have") >= 4 * F.col("want"), "OK").when(F.col("have") >= F.col("want"), "LOW").otherwise("CRITICAL"))


def quality_stats(rows: DataFrame, q: str) -> DataFrame:
    """Totals and mean, least and most score without zeros, and the upper median of all.

    The median is the value at rank n div 2, found from counts per value, so that no task holds all rows.
    """
    some = F.nullif(F.col(q), F.lit(0.0))
    stats = rows.agg(F.count("*").alias("total"), F.count_if(F.col(q) > 0).alias("with_score"), F.round(F.avg(some), 6).alias("mean"), F.min(some).cast("double").alias("least"), F.max(q).cast("double").alias("most"))
    per = rows.groupBy(q).agg(F.count("*").alias("n"))
    w = Window.orderBy(q)  # one row per distinct score
    ranked = per.select(q, F.sum("n").over(w).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("all"))
    median = ranked.filter(F.col("upto") > F.floor(F.col("all") / 2)).agg(F.min(q).cast("double").alias("upper_median"))
    return stats.crossJoin(median)  # one row each


def histogram(rows: DataFrame, x: str, bins: int) -> DataFrame:
    return rows.groupBy(F.floor(F.col(x) * bins).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def fixed_bins(rows: DataFrame, x: str, bins: int, most: float = 1.0) -> DataFrame:
    """Rows in so many equal bins from 0 to `most`, which is in the last one; values outside are in none."""
    at = F.least(F.floor(F.col(x) * F.lit(bins) / F.lit(most)), F.lit(bins - 1)).cast("long")
    return rows.filter((F.col(x) >= 0) & (F.col(x) <= most)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def adoption_report(rows: DataFrame, types: str = "types", most: int = 10) -> DataFrame:
    """One row over sites (existing, generated, quality, properties, types): how many have markup, and what was generated where something was.

    top_types: the most frequent types of all rows as name:count, ties by name.
    """
    made = F.col("generated")
    mean = lambda c, places: F.round(F.coalesce(F.avg(F.when(made, F.col(c))), F.lit(0.0)), places)
    sums = rows.agg(
        F.count("*").alias("total"), F.count_if("existing").alias("with_markup"), F.count_if(~F.col("existing")).alias("without_markup"),
        F.round(F.try_divide(F.count_if("existing"), F.count("*")), 3).alias("rate"), F.count_if(made).alias("valid"), mean("quality", 3).alias("mean_quality"), mean("properties", 1).alias("mean_properties"),
    )
    top = frequencies(rows.select(F.explode(types).alias("type")), "type", most)
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "type")))  # at most `most` rows
    return sums.crossJoin(top.agg(F.array_join(F.transform(listed, lambda x: F.concat(x["type"], F.lit(":"), (-x["k"]).cast("string"))), ",").alias("top_types")))  # one row each


def percentiles(rows: DataFrame, x: str, percents: tuple[int, ...], exact: bool = True) -> DataFrame:
    """Linear percentiles, or with exact=False approximate ones, whose state is small at any size."""
    at = F.array(*(F.lit(p / 100) for p in percents))
    found = rows.agg((F.percentile(x, at) if exact else F.percentile_approx(x, at)).alias("v"))
    return found.select(F.posexplode("v").alias("i", "chars")).select(F.element_at(F.array(*(F.lit(p) for p in percents)), F.col("i") + 1).alias("p"), F.round("chars", 6).cast("double").alias("chars"))


def coverage(rows: DataFrame, x: str, limits: list[int]) -> DataFrame:
    """Percentage of rows below each limit, in one pass; null without rows."""
    found = rows.agg(F.count("*").alias("n"), *(F.count_if(F.col(x) < v).alias(f"c{v}") for v in limits))
    each = F.array(*(F.struct(F.lit(v).cast("long").alias("at"), F.col(f"c{v}").alias("c")) for v in limits))
    return found.select("n", F.explode(each).alias("e")).select("e.at", F.round(F.try_divide(100.0 * F.col("e.c"), F.col("n")), 6).cast("double").alias("share"))


def costs(rows: DataFrame, tokens: tuple[int, int] = (5300, 1000), price: dict[str, float] = TOKEN_PRICE, hour: float = GPU_HOUR, seconds: float = PAGE_SECONDS) -> DataFrame:
    n = F.count("*")
    return rows.agg(n.alias("n"), F.round(n * tokens[0] / 1e6 * price["input"], 2).alias("input_cost"), F.round(n * tokens[1] / 1e6 * price["output"], 2).alias("output_cost"), F.round(n * seconds * hour / 3600, 2).alias("serving_cost"))


def learning_curve(counts: DataFrame, key: str, start: float = 52, gain: float = 35, rate: float = 0.00035) -> DataFrame:
    """Counts (key, n), largest first, with the examples so far and the F1 expected of a model that learns from them: start, and a gain that levels off."""
    so_far = F.sum("n").over(Window.orderBy(F.desc("n"), F.asc_nulls_last(key)).rowsBetween(Window.unboundedPreceding, 0))  # a row for each key
    return counts.select(key, so_far.alias("n")).withColumn("f1", F.round(start + gain * (1 - F.exp(-rate * F.col("n"))), 6))


def gold_and_predicted(rows: DataFrame, gold: str, pred: str, most: int = 8) -> DataFrame:
    """The most frequent gold types, with how often each is gold and how often predicted."""
    top = frequencies(rows, gold, most).select(F.col(gold).alias("kind"), F.col("n").alias("gold"))
    found = rows.groupBy(F.col(pred).alias("kind")).agg(F.count("*").alias("predicted"))
    return top.join(found, "kind", "left").select("kind", "gold", F.coalesce("predicted", F.lit(0)).cast("long").alias("predicted"))


def share_and_target(counts: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Percentages of all counts beside those wanted, for keys in both."""
    return shares(counts).join(shares(targets.withColumnRenamed("want", "n")).select(key, F.col("share").alias("target")), key).select(key, "share", "target")


def listed_counts(rows: DataFrame, lists: str) -> DataFrame:
    """How many rows list each value; one that a row repeats counts each time."""
    return rows.select(F.explode(lists).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


#: Size of a quantile sketch, with which ranks are off by less than RANK_ERROR, and log2 of a distinct counter's registers.
SKETCH, RANK_ERROR, REGISTERS = 400, 0.01, 12


def sketches(rows: DataFrame, batch: str, x: str, key: str) -> DataFrame:
    """Of each batch, n, and mergeable states: quantiles of a number, and distinct keys. Small tables, which stand for their batches from then on: a pool
    that grows adds a row for each new batch and reads none of the old ones again. Nulls count in n alone."""
    return rows.groupBy(batch).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(x).cast("double"), SKETCH).alias("quantiles"), F.hll_sketch_agg(F.col(key), REGISTERS).alias("keys"))


def merged_sketches(states: DataFrame, percents: tuple[int, ...]) -> DataFrame:
    """One row over all batches: n, n_keys (about), and values (percent, x), each x having a rank within RANK_ERROR of its percent. Null values without
    numbers."""
    whole = states.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.kll_merge_agg_double("quantiles", SKETCH).alias("q"), F.hll_union_agg("keys").alias("k"))
    at = [F.struct(F.lit(p).alias("percent"), F.kll_sketch_get_quantile_double("q", F.lit(p / 100)).alias("x")) for p in percents]
    some = F.col("q").isNotNull() & (F.kll_sketch_get_n_double("q") > 0)
    return whole.select("n", F.coalesce(F.hll_sketch_estimate("k"), F.lit(0)).alias("n_keys"), F.when(some, F.array(*at)).alias("values"))
