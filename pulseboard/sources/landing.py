"""Read landed record files. API clients are out of scope; files replace them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

BAD_RECORD = "_bad_record"


def read_landed_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with a declared schema; unreadable lines are kept aside.

    Column ``_bad_record`` holds the text of a line that did not parse, NULL
    otherwise, so that a bad record is counted rather than silently skipped.
    """
    with_bad = StructType([*schema.fields, StructField(BAD_RECORD, StringType())])
    return (spark.read.schema(with_bad)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_RECORD)
            .json(path))


def from_json_text(text: Column, schema: StructType) -> Column:
    """A landed JSON document in a string column, as a typed struct; one that cannot be read
    becomes a struct of NULLs, so use :func:`parsed` where such documents may occur."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def parsed(df: DataFrame, text: str, schema: StructType) -> DataFrame:
    """The documents of a text column as typed columns, with ``_bad_record`` as above.

    A document is unreadable if it is no JSON object or a value has another type than the
    schema says; a blank one too. A NULL is no document: it gives no row.
    """
    with_bad = StructType([*schema.fields, StructField(BAD_RECORD, StringType())])
    document = F.from_json(F.col(text), with_bad, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD})
    bad = F.coalesce(F.col(f"_d.{BAD_RECORD}"), F.when(
        F.col("_d").isNull() | (F.trim("_text") == ""), F.col("_text")))
    return (df.where(F.col(text).isNotNull()).select(F.col(text).alias("_text"),
                                                     document.alias("_d"))
            .select(*[F.col(f"_d.`{n}`").alias(n) for n in schema.names],
                    bad.alias(BAD_RECORD)))


def read_staging(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A staging table, passed through with its declared columns."""
    return spark.read.schema(schema).parquet(path)
