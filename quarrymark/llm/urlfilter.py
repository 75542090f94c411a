"""URL filters: rules first, then trust and distrust propagated over the graph of hosts.

Links between different hosts are counted from the pages' markup. Hosts of allowed pages are trusted seeds, and those of
blocked pages distrusted ones, each by its pages. Personalised PageRank carries trust along links, and distrust against
them; a host with enough more of the one than of the other is blocked or allowed as a whole. Rounds are joins of the edge
table with the ranks, dealt by salts so that a hub is no single task; each round's ranks are written in the shared folder.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import partitions, salted_join, unused, written

#: host, path, action.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Rules up to this number are a constant of the plan; more are joined by equality. Both give the same.
MOST_CONSTANT = 1000
DAMPING, CLOSE = 0.85, 1e-6
#: Blocked where (distrust - trust) / (distrust + trust) is above this.
THRESHOLD = 0.5
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def lower_az(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end; path: then up to ? or #. Both empty for null or without ://."""
    text = F.coalesce(url, F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise("")
    return lower_az(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _best(rules: Column, host: Column, path: Column) -> Column:
    """The longest fitting rule of an array of structs: a struct, or null. Of equally long ones that with the longer host."""
    fits = F.filter(rules, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(F.length(F.concat(r["host"], r["path"])).alias("n"), F.length(r["host"]).alias("h"), F.concat(r["host"], r["path"]).alias("rule"), r["action"].alias("action"))))


def with_rules(urls: DataFrame, rules: DataFrame | tuple = RULES) -> DataFrame:
    """urls, with host and path, and with rule and action of the longest rule that fits (null where none does).

    A rule fits its host and all subdomains, if the path starts with the rule's. rules: tuples or a table of host, path,
    action; rules with nulls fit nothing, and of equal rules "block" counts. Columns rule and action of urls are replaced.
    """
    name = unused(urls, "_b")
    if isinstance(rules, DataFrame):
        clean = rules.select(lower_az(F.col("host")).alias("host"), "path", "action").na.drop().groupBy("host", "path").agg(F.max("action").alias("action"))
        some = clean.limit(MOST_CONSTANT + 1).collect()
        if len(some) > MOST_CONSTANT:
            return _joined_rules(urls, clean, name)
        rules = tuple(tuple(r) for r in some)
    if not rules:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "action": F.lit(None).cast("string")})
    table = F.array(*(F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(a).alias("action")) for h, p, a in rules))
    return urls.withColumn(name, _best(table, F.col("host"), F.col("path"))).withColumns({"rule": F.col(f"{name}.rule"), "action": F.col(f"{name}.action")}).drop(name)


def _joined_rules(urls: DataFrame, rules: DataFrame, name: str) -> DataFrame:
    """Many rules, met by equality: a host and path asks for each suffix of the host with each prefix of the path that is as long as one of
    that suffix's rules. No host gathers rules, and what is asked is bounded by the labels of a host and the lengths of paths, however many
    rules there are. A url that many rows have asks once."""
    salts = 2 * partitions(urls.sparkSession)
    asked = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = asked.select("host", "path", F.explode(suffixes).alias("suffix"))
    mixed = F.xxhash64("host", "path")
    lengths = rules.groupBy(F.col("host").alias("suffix")).agg(F.collect_set(F.length("path")).alias("lengths"))
    tried = salted_join(asked, lengths, "suffix", mixed, salts).withColumn("n", F.explode(F.filter("lengths", lambda k: k <= F.length("path"))))
    tried = tried.select("host", "path", F.struct("suffix", F.substring("path", F.lit(1), F.col("n")).alias("prefix")).alias("key"))
    rule = F.concat("host", "path")
    table = rules.select(F.struct(F.col("host").alias("suffix"), F.col("path").alias("prefix")).alias("key"), F.struct(F.length(rule).alias("n"), F.length("host").alias("h"), rule.alias("rule"), "action").alias("b"))
    fits = salted_join(tried, table, "key", mixed, salts).filter("b IS NOT NULL")
    best = fits.groupBy(F.struct("host", "path").alias(name)).agg(F.max("b").alias("b")).select(name, F.col("b.rule").alias("rule"), F.col("b.action").alias("action"))
    keyed = urls.drop("rule", "action").withColumn(name, F.struct("host", "path"))
    plain = [F.col(f"`{c}`") for c, kind in keyed.dtypes if not re.search("map<|variant", kind)]
    return salted_join(keyed, best, name, F.xxhash64(*plain), salts).drop(name)


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, n: links from pages (host, html) to other hosts, with a scheme or from // on; other relative links stay on their host and
    don't count."""
    links = F.when(F.contains(F.col("html"), F.lit("//")), F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    return pages.select(F.col("host").alias("src"), F.explode(links).alias("dst")).select("src", lower_az(F.col("dst")).alias("dst")).filter("src <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None, close: float = CLOSE) -> DataFrame:
    """Personalised PageRank: host and rank, which adds up to 1 (no rows without seeds).

    edges: src, dst, n; seeds: host, weight. A host without links gives its rank back to the seeds, which only scales
    ranks: they are the seeds' weight carried along paths of every length, over the sum of it. Each round carries it one link
    on. Rounds end when what longer paths can still add is less than `close` in all and no new host was reached, however
    long the paths are; with `rounds`, after so many of the plain iteration, or when ranks move by less than `close`.
    """
    spark = edges.sparkSession
    seeds = seeds.filter("host IS NOT NULL AND weight > 0").groupBy("host").agg(F.sum("weight").alias("weight"))
    total = seeds.agg(F.sum("weight")).first()[0]
    if not total:
        return seeds.select("host", F.col("weight").cast("double").alias("rank"))
    seeds = written(seeds.select("host", (F.col("weight") / float(total)).alias("seed")), "seeds")
    out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    salts = 2 * partitions(spark)
    shares = written(salted_join(edges, out, "src", F.xxhash64("dst"), salts).select("src", "dst", (F.col("n") / F.col("total")).alias("share")), "shares")
    if shares.isEmpty():
        return seeds.select("host", F.col("seed").alias("rank"))
    if rounds is not None:
        return _iterated(shares, seeds, damping, rounds, close, salts)
    state, total, reached = seeds.select("host", F.col("seed").alias("rank"), F.col("seed").alias("carried")), 1.0, True
    rest = damping / (1 - damping)
    while reached or rest >= close * total:
        flow = salted_join(shares, state.filter("carried > 0").select(F.col("host").alias("src"), "carried"), "src", F.xxhash64("dst"), salts).filter("carried IS NOT NULL")
        given = flow.groupBy(F.col("dst").alias("host")).agg((F.sum(F.col("carried") * F.col("share")) * damping).alias("given"))
        moved = state.select("host", "rank").join(given, "host", "full")
        state = written(moved.select("host", (F.coalesce("rank", F.lit(0.0)) + F.coalesce("given", F.lit(0.0))).alias("rank"), F.coalesce("given", F.lit(0.0)).alias("carried"), F.col("rank").isNull().alias("new")), "ranks")
        added, reached = state.agg(F.sum("carried"), F.max("new")).first()
        total += added
        rest = added * damping / (1 - damping)
    return state.select("host", (F.col("rank") / total).alias("rank"))


def _iterated(shares: DataFrame, seeds: DataFrame, damping: float, rounds: int, close: float, salts: int) -> DataFrame:
    """Ranks after so many rounds from the seeds."""
    rank = seeds.select("host", F.col("seed").alias("rank"))
    linking = shares.select(F.col("src").alias("host")).distinct()
    for _ in range(rounds):
        flow = salted_join(shares, rank.withColumnRenamed("host", "src"), "src", F.xxhash64("dst"), salts)
        given = flow.groupBy(F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("given"))
        lost = rank.join(linking, "host", "left_anti").agg(F.sum("rank")).first()[0] or 0.0
        new = given.join(seeds, "host", "full").select("host", (F.lit(damping) * F.coalesce("given", F.lit(0.0)) + F.lit(1 - damping + damping * lost) * F.coalesce("seed", F.lit(0.0))).alias("rank"))
        new = written(new, "ranks")
        old = rank.withColumnRenamed("rank", "old")
        moved = new.join(old, "host", "full").agg(F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0]
        rank = new
        if moved < close:
            break
    return rank


def filter_urls(pages: DataFrame, rules: DataFrame | tuple = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """Verdicts on pages (page_id, url, html).

    A row out for each row in: page_id, host, path, rule, verdict (the rule's action, else its host's), trust, distrust. A host
    is blocked where (distrust - trust) / (distrust + trust) > threshold; one that neither reaches is allowed, as are urls
    without a host. Null markup has no links.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = written(with_rules(urls, rules), "ruled")
    edges = written(host_edges(pages.select(host.alias("host"), "html")), "edges")
    seed = lambda action: ruled.filter((F.col("action") == action) & (F.col("host") != "")).groupBy("host").agg(F.count("*").alias("weight"))
    trust = propagate(edges, seed("allow")).withColumnRenamed("rank", "trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagate(back, seed("block")).withColumnRenamed("rank", "distrust")
    zero = F.lit(0.0)
    hosts = trust.join(distrust, "host", "full").select("host", F.coalesce("trust", zero).alias("trust"), F.coalesce("distrust", zero).alias("distrust"))
    found = salted_join(ruled, written(hosts, "hosts"), "host", F.xxhash64("page_id", "path"), 2 * partitions(pages.sparkSession))
    t, d = F.coalesce("trust", zero), F.coalesce("distrust", zero)
    own = F.when((d - t) > F.lit(threshold) * (d + t), "block").otherwise("allow")
    return found.select("page_id", "host", "path", "rule", F.coalesce("action", own).alias("verdict"), t.alias("trust"), d.alias("distrust"))
