"""Column types that read the same from Spark and from the SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(df: DataFrame) -> DataFrame:
    """DECIMAL as DOUBLE, small integers as BIGINT, dates and times as text."""
    out = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            pattern = "yyyy-MM-dd HH:mm:ss.SSSSSS" if f.name == "enriched_at" else "yyyy-MM-dd HH:mm:ss"
            column = F.date_format(column, pattern)
        out.append(column.alias(f.name))
    return df.select(*out)
