"""Expectations over tables: each rule gives rows (rule, severity, key, message) for what breaks it, and nothing else."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIOLATION = "rule string, severity string, key string, message string"


@dataclass(frozen=True)
class Table:
    """A table under test and what names its rows."""

    df: DataFrame
    name: str
    key: str

    def _found(self, df: DataFrame, rule: str, message: Column, severity: str = "error", key: Column | None = None) -> DataFrame:
        shown = (F.col(self.key) if key is None else key).cast("string")
        return df.select(F.lit(f"{self.name}.{rule}").alias("rule"), F.lit(severity).alias("severity"), shown.alias("key"), message.alias("message"))

    def required(self, *cols: str) -> DataFrame:
        """Each null or blank value of the columns, in one pass."""
        blank = [F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(c)) for c in cols]
        rows = self.df.select("*", F.explode(F.array_compact(F.array(*blank))).alias("_c"))
        return self._found(rows, "required", F.concat(F.col("_c"), F.lit(" is blank")))

    def one_of(self, col: str, values: list[str]) -> DataFrame:
        """Values outside a list."""
        return self._found(self.df.filter(~F.col(col).isin(values)), f"one_of.{col}", F.concat(F.lit(f"{col} is "), F.col(col).cast("string")))

    def unique(self, *cols: str) -> DataFrame:
        """Keys that occur more than once."""
        n = self.df.groupBy(*cols).agg(F.count("*").alias("_n")).filter("_n > 1")
        return self._found(n, "unique." + ".".join(cols), F.concat(F.lit("occurs "), F.col("_n").cast("string"), F.lit(" times")), key=F.concat_ws(":", *[F.col(c).cast("string") for c in cols]))

    def refers_to(self, col: str, other: DataFrame, other_col: str) -> DataFrame:
        """Values that the other table lacks."""
        known = other.select(F.col(other_col).alias("_k")).distinct()
        lost = self.df.filter(F.col(col).isNotNull()).join(known, F.col(col) == F.col("_k"), "left_anti")
        return self._found(lost, f"refers_to.{col}", F.concat(F.lit(f"{col} "), F.col(col).cast("string"), F.lit(" is unknown")))

    def holds(self, rule: str, condition: Column, message: str, severity: str = "error") -> DataFrame:
        """Rows for which a condition is false or unknown."""
        return self._found(self.df.filter(~F.coalesce(condition, F.lit(False))), rule, F.lit(message), severity)

    def columns(self, wanted: list[str]) -> DataFrame:
        """Wanted columns that the table lacks."""
        lost = [c for c in wanted if c not in self.df.columns]
        return self.df.sparkSession.createDataFrame([(f"{self.name}.columns", "error", c, f"column {c} is missing") for c in lost], VIOLATION)

    def at_least(self, n: int) -> DataFrame:
        """One row if the table has fewer rows."""
        short = self.df.agg(F.count("*").alias("_n")).filter(F.col("_n") < n)
        return self._found(short, "at_least", F.concat(F.lit("has "), F.col("_n").cast("string"), F.lit(f" of {n} rows")), key=F.lit(self.name))

    def covers(self, col: str, wanted: list[str]) -> DataFrame:
        """Wanted values that don't occur."""
        there = self.df.agg(F.collect_set(F.when(F.col(col).isin(wanted), F.col(col))).alias("_s"))
        lost = there.select(F.explode(F.array_except(F.array(*[F.lit(w) for w in wanted]), F.col("_s"))).alias("_w"))
        return self._found(lost, f"covers.{col}", F.lit("doesn't occur"), key=F.col("_w"))

    def agrees_with(self, other: DataFrame, key: str, value: str) -> DataFrame:
        """Keys on one side only, and keys whose values differ."""
        from .relational import compare_sides

        rows = compare_sides(self.df, other, [key], value).filter("state <> 'equal'")
        return self._found(rows, f"agrees_with.{value}", F.col("state"), key=F.col(key))

    def without_tokens(self, col: str, tokens: list[str], scan: Column | None = None) -> DataFrame:
        """Texts that hold a forbidden token, whatever the case."""
        text = F.lower(F.col(col) if scan is None else scan)
        hit = F.array_join(F.filter(F.array(*[F.lit(t.lower()) for t in tokens]), lambda t: F.contains(text, t)), ",")
        return self._found(self.df.withColumn("_h", hit).filter("_h <> ''"), f"without_tokens.{col}", F.concat(F.lit("holds "), F.col("_h")))


def safe_path(x: Column) -> Column:
    """Relative, without .. parts, backslashes and control signs."""
    return (x != "") & ~x.startswith("/") & ~x.contains("\\") & ~x.rlike(r"(^|/)\.\.(/|$)") & ~x.rlike(r"[\x00-\x1f\x7f]")


def hex64(x: Column) -> Column:
    """A sha256 in lower-case hex."""
    return x.rlike("^[0-9a-f]{64}$")


def all_violations(*found: DataFrame) -> DataFrame:
    """One table of them."""
    return reduce(DataFrame.unionByName, found)


def rule_counts(violations: DataFrame, rules: list[str]) -> DataFrame:
    """(rule, n, status) of every rule, also of those that nothing breaks."""
    spark = violations.sparkSession
    dims = spark.createDataFrame([(r,) for r in rules], "rule string")
    n = violations.groupBy("rule").agg(F.count("*").alias("n"))
    return dims.join(n, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.coalesce("n", F.lit(0)) == 0, "passed").otherwise("failed").alias("status"))


def require_clean(violations: DataFrame) -> DataFrame:
    """The violations' count, which fails the query unless it is 0."""
    n = violations.agg(F.count("*").alias("n"), F.first(F.concat_ws(": ", "rule", "key", "message")).alias("m"))
    return n.select(F.when(F.col("n") > 0, F.raise_error(F.concat(F.lit("expectation failed: "), F.col("m"))).cast("bigint")).otherwise(F.col("n")).alias("n"))
