"""Batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_raw_json(spark: SparkSession, path: str, schema: str, multiline: bool = True) -> DataFrame:
    """JSON files by path or glob with a fixed schema.

    ``multiline=True`` reads files holding one pretty-printed array (one row
    per element).  Fields absent from the schema are dropped; a malformed
    record becomes an all-NULL row (PERMISSIVE), which the formatters drop.
    """
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path, multiLine=multiline)


#: Field that holds a record that is no object of the schema.
CORRUPT = "_corrupt_record"


def read_raw_json_checked(spark: SparkSession, path: str, schema: str, key: str = "id",
                          multiline: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1/S2 with account of bad records: ``(good, rejects)``.

    Each record is judged on its own, so one bad record costs no other:
    ``multiline`` files hold an array of records (or one record) each, others one record or
    array a line.  A reject is ``(source_file, reason, record)``: ``broken`` is text
    that is no JSON, or a record with a value of another type than the schema's; ``no_key`` a
    record without ``key``.  Empty files and lines hold nothing.  ``good`` has the
    schema's columns.  Both frames read the files: write ``judged_records`` once where both are needed.
    """
    judged = judged_records(spark, path, schema, key, multiline)
    return (judged.where(F.col("reason").isNull()).select("row.*"),
            judged.where(F.col("reason").isNotNull()).select("source_file", "reason", "record"))


def judged_records(spark: SparkSession, path: str, schema: str, key: str = "id", multiline: bool = True) -> DataFrame:
    """``(source_file, record, row, reason)`` of every record; ``reason`` is NULL for a good one."""
    text = (spark.read.text(path, wholetext=multiline)
            .select(F.input_file_name().alias("source_file"), F.trim(F.col("value"), F.lit(" \t\r\n")).alias("value"))
            .where("value <> ''"))
    records = F.when(F.col("value").startswith("{"), F.array("value")).otherwise(
        F.coalesce(F.from_json("value", "array<string>"), F.array("value")))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    each = text.select("source_file", F.explode(records).alias("record")).withColumn(
        "row", F.from_json("record", f"{schema.strip().rstrip(',')}, {CORRUPT} STRING", options))
    reason = (F.when(F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull(), "broken")
              .when(F.col(f"row.{key}").isNull(), "no_key"))
    return each.select("source_file", "record", F.col("row").dropFields(CORRUPT).alias("row"), reason.alias("reason"))


def daily_path(template: str, date: str) -> str:
    """The raw file(s) of one load date, e.g.
    ``daily_path("/raw/catalogue/daily_{date}.json", "20240102")``."""
    return template.format(date=date)


def stream_raw_json(spark: SparkSession, directory: str, schema: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: a directory of one-object JSON files as a stream."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(directory)


def read_silver(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """Partitioned Parquet (``dt=`` discovered).  With a schema the
    partition column's type is fixed; without, it is inferred, and ``dt`` is
    read as text also where all loads are dated.  A streaming
    sink's folder is read through its ``_spark_metadata`` log."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    df = r.parquet(root)
    if "dt" in df.columns and df.schema["dt"].dataType.simpleString() != "string":
        df = df.withColumn("dt", F.col("dt").cast("string"))
    return df


def read_loads(spark: SparkSession, root: str, schema: str | None = None, defaults: dict | None = None,
               loads: list[str] | None = None) -> DataFrame:
    """S4/S5 over loads whose columns differ: one frame, ``dt`` last and as text.

    With ``schema`` its columns are read from every load (narrower numbers are widened,
    other columns are not read); without, the loads' own schemas are merged.
    A column that a load lacks is NULL there, and ``defaults`` fill NULLs;
    with ``loads`` only those ``dt=`` folders are scanned.
    """
    r = spark.read.schema(f"{schema.strip().rstrip(',')}, dt STRING") if schema else spark.read.option("mergeSchema", "true")
    found = r.parquet(root)
    if loads is not None:
        found = found.where(F.col("dt").cast("string").isin(list(loads)))
    found = found.select(*[c for c in found.columns if c != "dt"], F.col("dt").cast("string").alias("dt"))
    present = {k: v for k, v in (defaults or {}).items() if k in found.columns}
    return found.na.fill(present) if present else found


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """S7."""
    return spark.read.parquet(path)


def has_rows(df: DataFrame) -> bool:
    """Empty-input guard (a LIMIT 1 job, no Python row transfer)."""
    return not df.isEmpty()
