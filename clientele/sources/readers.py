"""Reading typed files, registering views, describing tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.sources.schemas import require_columns


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ","
) -> DataFrame:
    """A delimited file with a header line, typed by ``schema``.

    The header is checked against the schema by Spark (``enforceSchema`` off),
    so a renamed or moved column fails instead of shifting values.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_columnar(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table; the columns of ``schema`` must all be there."""
    df = require_columns(spark.read.parquet(path), schema.fieldNames())
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def lenient_date(text: Column | str) -> Column:
    """Text to date; what cannot be read becomes null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(column).cast("date")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: name and number of rows, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def schema_listing(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: table, position, column, type and row count of its table.

    The row count comes from the data; the rest is the catalog's answer.
    """
    listings = [
        counted.select(
            "table_name",
            F.posexplode(
                F.array(
                    *[
                        F.struct(
                            F.lit(f.name).alias("column_name"),
                            F.lit(f.dataType.simpleString()).alias("column_type"),
                        )
                        for f in df.schema
                    ]
                )
            ).alias("ordinal", "field"),
            "row_count",
        ).select("table_name", "ordinal", "field.column_name", "field.column_type", "row_count")
        for name, df in tables.items()
        for counted in [row_counts({name: df})]
    ]
    return reduce(DataFrame.unionByName, listings)
