"""Joins, set operations and lookups as lazy DataFrame builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def last_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key: the last by order, as a dict build leaves it. A partial aggregation, not a window."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("_r"))
    return best.select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def lookup(left: DataFrame, right: DataFrame, keys: list[str], order: str | None = None, defaults: dict[str, object] | None = None) -> DataFrame:
    """A left equi join that can't fan out: with order, the last row of a key on the right counts. Missing values take their defaults."""
    out = left.join(last_per_key(right, keys, order) if order else right, keys, "left")
    return out.fillna(defaults) if defaults else out


def must_match(left: DataFrame, right: DataFrame, keys: list[str], what: str = "row") -> DataFrame:
    """An inner join that fails the query when a left row has no partner."""
    marked = left.join(right.withColumn("_hit", F.lit(True)), keys, "left")
    message = F.concat(F.lit(f"no matching {what} for "), F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))
    checked = F.when(F.col("_hit").isNull(), F.raise_error(message).cast("boolean")).otherwise(F.col("_hit"))
    return marked.withColumn("_hit", checked).filter("_hit").drop("_hit")


def lookup_by_either(left: DataFrame, right: DataFrame, first: tuple[str, str], second: tuple[str, str], value: str) -> Column | DataFrame:
    """Each left row with right's `value` by the first key pair, or else by the second."""
    a = right.select(F.col(first[1]).alias("_k1"), F.struct(value).alias("_v1"))
    b = right.select(F.col(second[1]).alias("_k2"), F.struct(value).alias("_v2"))
    out = left.join(a, left[first[0]] == F.col("_k1"), "left").join(b, left[second[0]] == F.col("_k2"), "left")
    return out.withColumn(value, F.coalesce("_v1", "_v2")[value]).drop("_k1", "_k2", "_v1", "_v2")


def merged_sides(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """A full outer merge of two tables of one schema: the first side's values, where it has none the second's; `sides` says where a key is."""
    rest = [c for c in first.columns if c not in keys]
    a = first.select(*keys, F.struct(*rest).alias("_a"))
    b = second.select(*keys, F.struct(*rest).alias("_b"))
    sides = F.when(F.col("_b").isNull(), "first").when(F.col("_a").isNull(), "second").otherwise("both")
    return a.join(b, keys, "full_outer").select(*keys, *[F.coalesce(F.col("_a")[c], F.col("_b")[c]).alias(c) for c in rest], sides.alias("sides"))


def same_identity(sides: dict[str, DataFrame], key: str, fields: list[str]) -> DataFrame:
    """(key, state): 'same' where all sides have the key and agree in all fields, else what is missing or differs, sides and fields in order."""
    out = None
    for name, df in sides.items():
        one = df.select(key, F.struct(*fields).alias(f"_{name}"))
        out = one if out is None else out.join(one, key, "full_outer")
    first = f"_{next(iter(sides))}"
    missing = [F.when(F.col(f"_{n}").isNull(), F.lit(f"{n} missing")) for n in sides]
    differs = [F.when(~F.col(f"_{n}")[f].eqNullSafe(F.col(first)[f]) & F.col(f"_{n}").isNotNull() & F.col(first).isNotNull(), F.lit(f"{n} differs in {f}")) for n in list(sides)[1:] for f in fields]
    said = F.array_join(F.array_compact(F.array(*missing, *differs)), "; ")
    return out.select(key, F.when(said == "", "same").otherwise(said).alias("state"))


def overlap(calls: DataFrame, truth: DataFrame, covered: DataFrame, keys: list[str]) -> DataFrame:
    """Each distinct key with its class: tp (called and in covered truth), outside (called and in truth beyond it), fp (called, in no truth), fn (covered truth not called).

    False positives are told by all truth, recall by the covered part. One aggregation over tagged keys; no joins.
    """

    def tag(df: DataFrame, bit: int) -> DataFrame:
        return df.select(*keys).withColumn("_b", F.lit(bit))

    bits = reduce(DataFrame.unionByName, (tag(calls, 1), tag(truth, 2), tag(covered, 4))).groupBy(*keys).agg(F.bit_or("_b").alias("_b"))
    b = F.col("_b")
    call, known, seen = b.bitwiseAND(1) > 0, b.bitwiseAND(2) > 0, b.bitwiseAND(4) > 0
    cls = F.when(call & seen, "tp").when(call & known, "outside").when(call, "fp").when(seen, "fn")
    return bits.withColumn("cls", cls).drop("_b").filter("cls IS NOT NULL")


def recall_precision(classes: DataFrame) -> DataFrame:
    """tp, fp, fn, recall and precision of overlap()'s rows."""
    n = {k: F.count_if(F.col("cls") == k) for k in ("tp", "fp", "fn", "outside")}
    out = classes.agg(*[v.alias(k) for k, v in n.items()])
    return out.withColumn("recall", F.round(F.try_divide("tp", F.col("tp") + F.col("fn")), 4)).withColumn("precision", F.round(F.try_divide("tp", F.col("tp") + F.col("fp")), 4))


def compare_sides(expected: DataFrame, found: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A full outer check of two tables: missing, unexpected, differs or equal for each key."""
    a = expected.select(*keys, F.col(value).alias("expected"), F.lit(True).alias("_a"))
    b = found.select(*keys, F.col(value).alias("found"), F.lit(True).alias("_b"))
    state = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "unexpected").when(F.col("expected").eqNullSafe(F.col("found")), "equal").otherwise("differs")
    return a.join(b, keys, "full_outer").select(*keys, "expected", "found", state.alias("state"))


def paired(df: DataFrame, key: str, mate: str, value: str) -> DataFrame:
    """The two mates of each key side by side; keys without both are left out."""
    return df.groupBy(key).pivot(mate, ["1", "2"]).agg(F.first(value)).withColumnsRenamed({"1": "first", "2": "second"}).filter("first IS NOT NULL AND second IS NOT NULL")


def join_members(left: DataFrame, right: DataFrame, left_list: str, right_key: str) -> DataFrame:
    """Left rows with each right row whose key is in their list; a list that repeats a key joins once."""
    out = left.withColumn("_m", F.explode(F.array_distinct(F.col(left_list))))
    return out.join(right, out["_m"] == right[right_key]).drop("_m")


def merged_by_priority(sides: list[DataFrame], keys: list[str]) -> DataFrame:
    """The union of tables of one schema; of rows with one key, that of the latest table stays."""
    tagged = reduce(DataFrame.unionByName, [d.withColumn("_p", F.lit(i)) for i, d in enumerate(sides)])
    return last_per_key(tagged, keys, "_p").drop("_p")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def in_order(df: DataFrame, order: list[Column], bucket: Column, name: str = "ordinal") -> DataFrame:
    """Each row's place from 1 on in a total order, without gathering all rows in one task.

    `bucket` must not decrease along the order: rows are numbered within buckets, and the few bucket sizes are summed up.
    """
    b = df.withColumn("_b", bucket)
    sizes = b.groupBy("_b").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    ranked = b.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(*order)))
    return ranked.join(before, "_b").withColumn(name, F.col("_before") + F.col("_r")).drop("_b", "_r", "_before")


def ordered_parts(df: DataFrame, order: list[Column]) -> DataFrame:
    """df sorted by range over all partitions and written to the shared folder, with `_part` and `_at`: a row's partition and place in it."""
    from ..sources.tables import checkpointed

    rows = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    return rows.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))


def before_parts(rows: DataFrame, weight: Column) -> DataFrame:
    """(_part, _before): what all rows in earlier partitions weigh. A row a partition, of which there are a few thousand."""
    sums = rows.groupBy("_part").agg(F.sum(weight).alias("_n"))
    return sums.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))


def numbered(df: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """Each row's place from 1 on in a total order. No window holds rows, whatever the order's values."""
    rows = ordered_parts(df, order)
    return rows.join(F.broadcast(before_parts(rows, F.lit(1))), "_part").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")
