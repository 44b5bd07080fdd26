"""Aggregations: statistics, pivots, matrices and counters, each with partial aggregation before its shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import finite
from . import relational


def first_seen_groups(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(key, members): each group's values in input order."""
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias("members"))


def pivot_last(df: DataFrame, key: str, name: str, value: str, order: str, names: list[str]) -> DataFrame:
    """Attribute rows as one row a key; the last value of an attribute counts."""
    return df.groupBy(key).pivot(name, names).agg(F.max_by(value, order))


def quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(keys, one column a share): exact quantiles by linear interpolation of finite values, of many groups at once.

    No task holds a group's values: equal ones are counted first, the counts of all groups are sorted by range, and a running sum over
    partitions says which rows hold the wanted places. A group of any size, or a value of any frequency, is spread like the rest.
    Groups without finite values have no row.
    """
    counts = df.select(*keys, finite(value).cast("double").alias("_v")).filter("_v IS NOT NULL").groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    rows = relational.ordered_parts(counts, [*map(F.col, keys), F.col("_v")])
    own = F.sum("_n").over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_own", own).join(F.broadcast(relational.before_parts(rows, F.col("_n"))), "_part")
    rows = rows.select(*keys, "_v", (F.col("_before") + F.col("_own") - F.col("_n")).alias("_from"), (F.col("_before") + F.col("_own")).alias("_to"))
    totals = rows.groupBy(*keys).agg(F.min("_from").alias("_first"), F.max("_to").alias("_last"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys] or [F.lit(True)]
    placed = rows.alias("r").join(totals.alias("t"), same)
    place = lambda q: (F.col("_last") - F.col("_first") - 1) * F.lit(float(q))
    at = lambda n: (F.col("_from") <= F.col("_first") + n) & (F.col("_first") + n < F.col("_to"))
    ends = [(f"_{name}_{i}", at(end(place(q)).cast("long"))) for name, q in shares.items() for i, end in enumerate((F.floor, F.ceil))]
    hits = placed.filter(reduce(lambda a, b: a | b, [hit for _, hit in ends]))
    found = hits.groupBy(*[F.col(f"r.{k}").alias(k) for k in keys], "_first", "_last").agg(*[F.max(F.when(hit, F.col("_v"))).alias(name) for name, hit in ends])
    between = lambda name, q: F.col(f"_{name}_0") + (F.col(f"_{name}_1") - F.col(f"_{name}_0")) * (place(q) - F.floor(place(q)))
    return found.select(*keys, *[between(name, q).alias(name) for name, q in shares.items()])


def describe_numbers(df: DataFrame, keys: list[str], value: str, places: int = 4) -> DataFrame:
    """n, mean, sd (null below two), median and quartiles by linear interpolation, of finite values only."""
    v = finite(value)
    sums = df.groupBy(*keys).agg(F.count(v).alias("n"), F.round(F.avg(v), places).alias("mean"), F.round(F.stddev_samp(v), places).alias("sd"))
    marks = quantiles(df, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys] or [F.lit(True)]
    joined = sums.alias("s").join(marks.alias("m"), same, "left")
    return joined.select(*[f"s.{k}" for k in keys], "n", "mean", "sd", *[F.round(c, places).alias(c) for c in ("q1", "median", "q3")])


def z_scores(df: DataFrame, group: str, value: str, least: int = 1) -> DataFrame:
    """Rows with z of a value within its group; a spread of 0 or none counts as 1. Groups with fewer than `least` finite values go.

    The group's figures are aggregated and joined back: a hot group is summed where it is read.
    """
    v = finite(value)
    stats = df.groupBy(group).agg(F.avg(v).alias("_m"), F.stddev_samp(v).alias("_s"), F.count(v).alias("_n"))
    spread = F.coalesce(F.nullif(F.col("_s"), F.lit(0.0)), F.lit(1.0))
    return df.join(stats.filter(F.col("_n") >= least), group).withColumn("z", (v - F.col("_m")) / spread).drop("_m", "_s", "_n")


def module_means(scores: DataFrame, modules: DataFrame, gene: str, unit: str, z: str = "z") -> DataFrame:
    """(unit, module, score): mean z of a module's genes."""
    return scores.join(modules, gene).groupBy(unit, "module").agg(F.avg(z).alias("score"))


def signature_scores(scores: DataFrame, signature: DataFrame, gene: str, unit: str, z: str = "z") -> DataFrame:
    """(unit, signature, score): the mean of the mean products with positive and with other coefficients, or the one there is."""
    product = F.col(z) * F.col("coefficient")
    up, down = F.avg(F.when(F.col("coefficient") > 0, product)), F.avg(F.when(F.col("coefficient") <= 0, product))
    out = scores.filter(F.col(z).isNotNull()).join(signature, gene).groupBy(unit, "signature").agg(up.alias("_u"), down.alias("_d"))
    score = F.when(F.col("_u").isNull(), F.col("_d")).when(F.col("_d").isNull(), F.col("_u")).otherwise((F.col("_u") + F.col("_d")) / 2)
    return out.select(unit, "signature", score.alias("score"))


def confusion(df: DataFrame, expected: Column, predicted: Column) -> DataFrame:
    """(expected, predicted, n)."""
    return df.groupBy(expected.alias("expected"), predicted.alias("predicted")).agg(F.count("*").alias("n"))


def zero_filled(counts: DataFrame, dims: DataFrame, keys: list[str], value: str = "n") -> DataFrame:
    """Every key of dims with its count, 0 where there is none."""
    return dims.join(counts, keys, "left").withColumn(value, F.coalesce(F.col(value), F.lit(0)))


def count_values(df: DataFrame, col: str, blank: str = "(blank)") -> DataFrame:
    """(value, n): blanks and nulls under one name."""
    return df.groupBy(F.coalesce(F.nullif(F.trim(F.col(col).cast("string")), F.lit("")), F.lit(blank)).alias("value")).agg(F.count("*").alias("n"))


def joined_values(col: Column, sep: str = ";", none: str = "none") -> Column:
    """An aggregate: sorted distinct values in one text."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.collect_set(col)), sep), F.lit("")), F.lit(none))


def single_or(col: Column, other: str) -> Column:
    """An aggregate: the one distinct value, or a word for several."""
    return F.when(F.min(col) == F.max(col), F.min(col)).when(F.count(col) > 0, F.lit(other))


def best_by(df: DataFrame, key: str, order: list[Column], cols: list[str]) -> DataFrame:
    """A group's row with the smallest order, as an aggregate."""
    return df.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_b")).select(key, "_b.*")


def share_of_total(df: DataFrame, keys: list[str], value: str, floor: float = 1e-9) -> DataFrame:
    """Rows with their value's share of the keys' total."""
    total = df.groupBy(*keys).agg(F.sum(value).alias("_t"))
    return df.join(total, keys).withColumn("share", F.col(value) / F.greatest(F.col("_t"), F.lit(floor))).drop("_t")


def sparse_matrix(df: DataFrame, row: str, col: str, value: str, first: list[str]) -> DataFrame:
    """(row, cells): a map of column to largest value, preferred columns first."""
    cells = df.groupBy(row, col).agg(F.max(value).alias("_v"))
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(x) for x in first]), F.col(col)), F.lit(0)), F.lit(len(first) + 1))
    listed = F.array_sort(F.collect_list(F.struct(place.alias("p"), F.col(col).alias("k"), F.col("_v").alias("v"))))
    return cells.groupBy(row).agg(F.transform(listed, lambda x: F.struct(x.k.alias("k"), x.v.alias("v"))).alias("cells"))


def prefix_rollup(df: DataFrame, path: str, size: str, modified: str) -> DataFrame:
    """(prefix, files, bytes, latest): figures of every folder on a path, the root ''."""
    parts = F.split(F.col(path), "/")
    prefixes = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    return df.select(F.explode(prefixes).alias("prefix"), F.col(size).alias("_s"), F.col(modified).alias("_m")).groupBy("prefix").agg(F.count("*").alias("files"), F.sum("_s").alias("bytes"), F.max("_m").alias("latest"))


def sampled_costs(samples: DataFrame, key: str, ts: str, rate: str) -> DataFrame:
    """(key, day, cost): dollars between consecutive looks at a running machine, six places, counted in the later look's day."""
    order = Window.partitionBy(key).orderBy(ts)
    last = F.lag(ts).over(order).cast("timestamp")
    day = F.date_trunc("day", F.col(ts).cast("timestamp"))
    seconds = F.greatest(F.lit(0), F.unix_seconds(F.col(ts).cast("timestamp")) - F.unix_seconds(F.greatest(day, F.coalesce(last, F.col(ts).cast("timestamp")))))
    cost = (seconds * F.col(rate) / 3600).cast("decimal(18,6)")
    return samples.select(key, F.to_date(day).alias("day"), cost.alias("cost")).groupBy(key, "day").agg(F.sum("cost").cast("decimal(18,6)").alias("cost"))
