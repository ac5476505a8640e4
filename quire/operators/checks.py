"""Required-column checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.schemas import required


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: how many rows hold NULL there. One pass, one tiny shuffle."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns
    ])
    return counted.select(F.inline(pairs))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the stored schema and stop the job on a NULL in a required column.

    The guard rides on the write itself, so no extra pass over the data is made.
    """
    needed = set(required(schema))
    out = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType)
        if field.name in needed:
            message = F.lit(f"required column {field.name} is NULL")
            value = F.coalesce(value, F.raise_error(message).cast(field.dataType))
        out.append(value.alias(field.name))
    return df.select(*out)
