"""Sinks. Large results are written in parallel by Spark's committer; single files are for reports of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import digests, exists


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, create_only: bool = False, single: bool = False) -> None:
    """Header, chosen columns in order, nulls as blanks. create_only refuses to overwrite."""
    out = df.select(*(columns or df.columns))
    out = out.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in out.columns])
    (out.coalesce(1) if single else out).write.mode("errorifexists" if create_only else "overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """One object a line."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_if_changed(df: DataFrame, path: str, keys: list[str]) -> bool:
    """Writes Parquet only where the rows differ from what is there; says whether it wrote."""
    spark = df.sparkSession
    digest = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64(*sorted(d.columns)).cast("decimal(20,0)"))).first()
    if exists(spark, path):
        old = spark.read.parquet(path)
        if sorted(old.columns) == sorted(df.columns) and digest(old) == digest(df):
            return False
    df.sort(*keys).write.mode("overwrite").parquet(path)
    return True


def markdown(df: DataFrame, order: list[str], limit: int = 1000) -> str:
    """A report table as Markdown text; more than `limit` rows are no report, and fail."""
    from ..functions.text import markdown_cell

    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[markdown_cell(c) for c in df.columns]), F.lit(" |"))
    lines = [r[0] for r in df.orderBy(*order).limit(limit + 1).select(row).collect()]
    if len(lines) > limit:
        raise ValueError(f"more than {limit} rows for a report")
    return "\n".join(["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns), *lines]) + "\n"


def upsert(current: DataFrame, updates: DataFrame, keys: list[str], order: str) -> DataFrame:
    """current with its rows replaced by the latest update of their key."""
    from ..operators.relational import last_per_key

    latest = last_per_key(updates, keys, order).select(*current.columns)
    return current.join(latest, keys, "left_anti").unionByName(latest)


def append_once(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The batch's rows whose key isn't there yet, one each."""
    return batch.dropDuplicates([key]).join(existing.select(key), key, "left_anti")


def artifact_index(spark, path: str | list[str]) -> DataFrame:
    """(path, bytes, sha256) of files."""
    return digests(spark, path).drop("md5")


def document(df: DataFrame, value: str, path: str, create_only: bool = True) -> None:
    """Whole documents, a row each, as text with a newline at the end; create_only refuses a folder that is there."""
    ended = F.regexp_replace(F.col(value), r"\n+$", "")
    df.select(ended.alias("value")).write.mode("errorifexists" if create_only else "overwrite").text(path)


def verified_copy(source: DataFrame, copy: DataFrame, name: str = r"([^/]*)$") -> DataFrame:
    """(name, state) of two indexes by what `name` (a regular expression with a group) reads from paths: equal, differs, missing or unexpected."""
    from ..operators.relational import compare_sides

    named = lambda d: d.select(F.regexp_extract("path", name, 1).alias("name"), F.concat_ws(":", "bytes", "sha256").alias("digest"))
    return compare_sides(named(source), named(copy), ["name"], "digest").select("name", "state")
