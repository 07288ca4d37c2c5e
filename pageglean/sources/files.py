"""Files that go in and out of the jobs."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pageglean.operators import links as L
from pageglean.operators.segments import publishable

PART_ROWS = 2500
RESULT_SCHEMA = "url string, category string, keyword string, flag string, listpoints string, sumofpoints string"
QA_SCHEMA = f"{RESULT_SCHEMA}, numberofkeywords int"


_BAD = "bad_line"


def scan_urls(spark: SparkSession, folder: str) -> DataFrame:
    """All lines of the gz files in a dated folder: ``page_url``, the ``file``, and the line itself as ``bad_line`` where it is malformed.

    A line with too many or too few fields is malformed, which is only noticed when all of its fields are read.
    """
    lines = (spark.read.option("header", True).option("quote", '"').option("escape", "\\").option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", _BAD).option("columnPruning", False).option("pathGlobFilter", "*.gz"))
    # The header names the columns; the one for malformed lines has to be named too.
    columns = lines.csv(folder).schema
    # The column of malformed lines may not be read alone, as it would be by a count; no length is below 0.
    bad = F.coalesce(F.col(_BAD), F.when(F.length("page_url") < 0, ""))
    return lines.schema(columns.add(_BAD, "string")).csv(folder).select("page_url", F.col("_metadata.file_path").alias("file"), bad.alias(_BAD))


def read_urls(spark: SparkSession, folder: str, bad_folder: str | None = None) -> DataFrame:
    """The ``page_url`` column of all gz files in a dated folder. Malformed lines are left out, and kept in ``bad_folder``."""
    lines = scan_urls(spark, folder)
    if bad_folder is not None:
        lines.filter(F.col(_BAD).isNotNull()).write.mode("overwrite").json(bad_folder)
    return lines.filter(F.col(_BAD).isNull()).select("page_url")


def scan_report(lines: DataFrame, *by: str) -> DataFrame:
    """Number of good and bad lines of each file, and of the URLs in its good ones."""
    good = F.col(_BAD).isNull()
    return lines.groupBy(*(by or ("file",))).agg(
        F.count_if(good).alias("good"), F.count_if(~good).alias("bad"), F.count_if(good & F.col("page_url").isNotNull()).alias("urls"))


def write_url_parts(urls: DataFrame, folder: str, rows: int = PART_ROWS) -> None:
    """Distinct URLs as gz files with a header, each with exactly ``rows`` URLs but for the last one.

    A range of whole parts goes to each task, in order, so the writer's row limit falls on the ends of parts.
    """
    parts = L.url_parts(urls, rows).repartitionByRange("part").sortWithinPartitions("part", "page_url").select("page_url")
    (parts.write.mode("overwrite").option("maxRecordsPerFile", rows).option("header", True)
     .option("compression", "gzip").csv(folder))


def write_keyword_list(vocab: DataFrame, path: str) -> None:
    """Vocabulary as comma-ended entries on one line."""
    vocab.select("keyword").write.mode("overwrite").option("lineSep", ",").option("sep", "\x01").csv(path)


def read_keyword_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("keyword string").option("lineSep", ",").option("sep", "\x01").csv(path)


def write_export(table: DataFrame, folder: str) -> int:
    """Writes the table as gz files; gives its number of rows, counted by the write."""
    counted = Observation()
    table.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True).option("compression", "gzip").csv(folder)
    return counted.get["rows"]


def read_export(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Exported table with its types."""
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", "\\").csv(folder)


def write_results(rows: DataFrame, folder: str) -> None:
    """Segment results, a folder per segment; a segment without results gets none."""
    # Static, so that a segment that had results in an earlier run of the day and has none now loses its folder.
    (rows.hint("rebalance", "custom_segment_id").write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("custom_segment_id").option("header", True).csv(folder))


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    """Results of all segments."""
    return spark.read.schema(f"{RESULT_SCHEMA}, custom_segment_id bigint").option("header", True).option("escape", "\\").csv(folder)


def drop_expired(spark: SparkSession, folder: str, run_date: str, days: int = 7) -> None:
    """Removes the dated folders ``run_date=...`` that are at least ``days`` days older than this run."""
    last = str(date.fromisoformat(run_date) - timedelta(days=days))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(path) if files.exists(path) else []:
        name = status.getPath().getName()
        if name.startswith("run_date=") and name.removeprefix("run_date=") <= last:
            files.delete(status.getPath(), True)


def publish(table: DataFrame, folder: str) -> None:
    """Table without double quotes in its text, as CSV with a header."""
    publishable(table).write.mode("overwrite").option("header", True).csv(folder)


def read_published(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(folder)


def label_of(domain: str) -> str:
    return domain.replace(".", "_")


def read_table(spark: SparkSession, name: str, kind: str = "parquet", **options: str) -> DataFrame:
    """A table by path, or by the options of a data source such as ``jdbc``.

    For ``jdbc`` give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``, or one task reads it all.
    """
    reader = spark.read.format(kind).options(**options)
    return reader.option("dbtable", name).load() if kind == "jdbc" else reader.load(name)
