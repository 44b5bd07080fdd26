"""Delimited, JSON and document sources. CSV values are strings and blanks stay blank, as a header-driven reader gives them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNUSED = "\u0001"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir. Where that is unset it is set: to a folder of the
    warehouse on a cluster, to a temporary one, removed at the end, where driver and executors are one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.startswith("local["):
            import atexit
            import shutil
            import tempfile

            found = tempfile.mkdtemp(prefix="meridia-")
            atexit.register(shutil.rmtree, found, True)
        else:
            found = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared folder, which cuts its lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def csv(spark: SparkSession, path: str | list[str], sep: str = ",", columns: list[str] | None = None) -> DataFrame:
    """All-string rows by header; with columns, no file is read to learn them."""
    r = spark.read.option("header", True).option("sep", sep).option("nullValue", UNUSED).option("emptyValue", "").option("multiLine", sep == ",").option("escape", '"')
    if columns:
        r = r.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).option("enforceSchema", False)
    out = r.csv(path)
    return out.fillna("", [f.name for f in out.schema if isinstance(f.dataType, T.StringType)])


def tsv(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """csv() with tabs."""
    return csv(spark, path, "\t", columns)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system Spark reads it from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def csv_if_exists(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """csv(), or no rows where there is no file."""
    if exists(spark, path):
        return csv(spark, path, sep)
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def json_documents(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """(path, sha256, document): a whole JSON file a row as VARIANT, with the digest of the same bytes. Strict raises on repeated names."""
    files = spark.read.format("binaryFile").load(path)
    text = F.decode("content", "UTF-8")
    return files.select("path", F.sha2("content", 256).alias("sha256"), (F.parse_json(text) if strict else F.try_parse_json(text)).alias("document"))


def json_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON rows of a known schema; gzip goes by the extension."""
    return spark.read.schema(schema).json(path)


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str, one_a_line: bool = False) -> DataFrame:
    """Elements of XML files as rows: whole documents, or an element a line, which Spark can split."""
    return spark.read.format("xml").option("rowTag", row_tag).option("multiLine", not one_a_line).schema(schema).load(path)


def digests(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, bytes, sha256, md5) of files."""
    return spark.read.format("binaryFile").load(path).select("path", F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))


def checksum_list(spark: SparkSession, path: str) -> DataFrame:
    """(digest, name) of sha256sum or md5sum lines; other lines are left out."""
    pattern = r"^([0-9a-fA-F]{64}|[0-9a-fA-F]{32})\s+\*?(.+)$"
    return spark.read.text(path).filter(F.col("value").rlike(pattern)).select(F.lower(F.regexp_extract("value", pattern, 1)).alias("digest"), F.regexp_extract("value", pattern, 2).alias("name"))


def modified(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, modified) without reading contents."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("modificationTime").alias("modified"))


def is_current(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """One row: whether the oldest output is newer than the newest input."""
    return outputs.agg(F.min("modified").alias("oldest")).crossJoin(inputs.agg(F.max("modified").alias("newest"))).select((F.col("oldest") > F.col("newest")).alias("current"))


def trace(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Workflow trace rows of several files, repeated headers and nameless rows left out, with durations in seconds."""
    from ..functions.text import duration_seconds, stage_name

    rows = tsv(spark, path)
    rows = rows.filter((F.col("task_id") != "task_id") & (F.col("name") != ""))
    return rows.withColumn("duration_s", duration_seconds("duration")).withColumn("realtime_s", duration_seconds("realtime")).withColumn("stage", stage_name("name"))


def manifests(spark: SparkSession, pattern: str, schema: str, run: str) -> DataFrame:
    """JSON manifests that a path pattern finds, with the run that `run` (a regular expression with a group) reads from each path; malformed entries are left out."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(pattern)
    return rows.select(F.regexp_extract(F.col("_metadata.file_path"), run, 1).alias("run"), *rows.columns)


def matrix_configs(matrix: Column, default: dict[str, object]) -> Column:
    """Array of struct(strategy, concurrency, bytes, parts, label) of `strategy:concurrency:bytes:parts[:label]`, comma-separated; blanks take the defaults."""
    items = F.filter(F.transform(F.split(matrix, ","), lambda x: F.trim(x)), lambda x: x != "")

    def config(x: Column) -> Column:
        p = F.split(x, ":")
        at = lambda i: F.nullif(F.trim(F.get(p, F.lit(i))), F.lit(""))
        number = lambda i, k: F.coalesce(at(i).cast("long"), F.lit(default[k]).cast("long")).alias(k)
        strategy = F.coalesce(at(0), F.lit(default["strategy"]))
        return F.struct(strategy.alias("strategy"), number(1, "concurrency"), number(2, "bytes"), number(3, "parts"), F.coalesce(at(4), strategy).alias("label"))

    return F.transform(items, config)
