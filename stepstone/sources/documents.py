"""Reading wrapped JSON documents and quoted CSV reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_documents(spark: SparkSession, path: str, header: T.StructType, rows: str, row: T.StructType, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(headers, rows) of JSON documents that wrap one array of row objects.

    Documents are one per line, or one per file with ``multi_line``; the schema is given, never inferred.
    """
    schema = T.StructType([*header.fields, T.StructField(rows, T.ArrayType(row))])
    docs = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    heads = docs.select(*header.names, F.coalesce(F.size(rows), F.lit(0)).alias("row_count"))
    return heads, docs.select(*header.names, F.inline(rows))


def read_report(spark: SparkSession, path: str, columns: list[str], multi_line: bool = False) -> DataFrame:
    """Quoted CSV: lines of another width, blank lines and repeated headers are dropped.

    Column pruning is off for this read, since only then the width of a line is looked at.  With ``multi_line`` quoted
    values may hold line breaks, and a file is then read as a whole.
    """
    schema = T.StructType([T.StructField(c.strip(), T.StringType()) for c in columns])
    rows = (
        spark.read.schema(schema)
        .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
        .option("mode", "DROPMALFORMED").option("columnPruning", False)
        .csv(path)
    )
    first = schema.names[0]
    some = F.lit(False)
    for name in schema.names:
        some = some | (F.coalesce(F.col(name), F.lit("")) != "")
    return rows.where(some & ~F.trim(first).eqNullSafe(first))
