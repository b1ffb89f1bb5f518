"""CSV files to bronze: every column as text, missing-value tokens as NULL, lineage added."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.catalogue import LINEAGE, TABLES, source_file

# Texts that count as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


_RECORD = "_uneven_record"


def scan_text(
    spark: SparkSession, path: str, columns: list[str], multi_line: bool = False, file_column: str | None = None
) -> DataFrame:
    """Read the named columns of a header CSV, whatever their order in it.

    A row with fewer fields than the header has NULL for the rest; one with more fields stops the job. `multi_line`
    allows line breaks inside quotes, at the cost of two more scans (see scan_records). `file_column` names a column for
    the file of each row, as its reader gives it.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns  # reads the first line
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"the header of {path} lacks {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _RECORD]])
    if multi_line:
        from tierline.sources.records import scan_records  # needs Arrow

        ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
        parsed = F.from_csv("record", ddl, {"escape": '"', "columnNameOfCorruptRecord": _RECORD})
        found = scan_records(spark, path).filter("NOT header").select(parsed.alias("row"), "file")
        raw = found.selectExpr("row.*", "reverse(substring_index(reverse(file), '/', 1)) AS _file_name")
    else:
        raw = reader.schema(schema).option("columnNameOfCorruptRecord", _RECORD).option("columnPruning", False).csv(path)
        if file_column:
            raw = raw.select("*", F.col("_metadata.file_name").alias("_file_name"))
    # The record is at hand where its fields are not as many as the header's; separators outside quotes tell them.
    bare = F.regexp_replace(_RECORD, '"(?:[^"]|"")*"', "")
    too_long = F.col(_RECORD).isNotNull() & (F.regexp_count(bare, F.lit(",")) >= len(names))
    complaint = F.raise_error(F.concat(F.lit(f"{path}: more fields than the header in "), F.col(_RECORD))).cast("string")
    values = [F.when(too_long, complaint).when(~F.col(c).isin(*NA_TOKENS), F.col(c)).alias(c) for c in columns]
    return raw.select(*values, *([F.col("_file_name").alias(file_column)] if file_column else []))


def with_lineage(df: DataFrame, file_name: str | None, ingested_at: datetime, batch_id: str) -> DataFrame:
    """The rows with their lineage. Without `file_name`, each row already has its own file in that column."""
    moment = ingested_at.strftime("%Y-%m-%d %H:%M:%S.%f%z")
    file = [] if file_name is None else [f"'{file_name}' AS {LINEAGE[0]}"]
    return df.selectExpr("*", *file, f"timestamp'{moment}' AS {LINEAGE[1]}", f"'{batch_id}' AS {LINEAGE[2]}")


def table_path(raw_dir: str, name: str) -> str:
    return f"{raw_dir}/{TABLES[name].domain}/{source_file(name)}"


def read_bronze(
    spark: SparkSession, raw_dir: str, name: str, ingested_at: datetime, batch_id: str, multi_line: bool = False
) -> DataFrame:
    """A bronze table from its file, or from a folder of that name; each row names the file it was read from."""
    df = scan_text(spark, table_path(raw_dir, name), list(TABLES[name].columns), multi_line, LINEAGE[0])
    return with_lineage(df, None, ingested_at, batch_id)
