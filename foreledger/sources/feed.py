"""Feed documents: nested JSON responses to flat, typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foreledger.functions.scalars import feed_ts

INTENSITY = T.StructType(
    [
        T.StructField("forecast", T.IntegerType()),
        T.StructField("actual", T.IntegerType()),
        T.StructField("index", T.StringType()),
    ]
)
RESPONSE = T.StructType(
    [
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("from", T.StringType()),
                        T.StructField("to", T.StringType()),
                        T.StructField("intensity", INTENSITY),
                    ]
                )
            ),
        )
    ]
)


def parse_feed(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Unnest responses into (good, bad) records.

    A record is good when both ends of its period parse and it has an intensity
    block; the fields inside the block may be NULL. A response that is no JSON
    at all comes out as one bad record.
    """
    rest = [c for c in df.columns if c != column]
    records = (
        df.withColumn("__doc", F.from_json(column, RESPONSE))
        .select(*rest, F.explode_outer("__doc.data").alias("__r"))
        .select(
            *rest,
            F.col("__r.from").alias("from_text"),
            F.col("__r.to").alias("to_text"),
            feed_ts(F.col("__r.from")).alias("from"),
            feed_ts(F.col("__r.to")).alias("to"),
            F.col("__r.intensity").alias("intensity"),
        )
    )
    whole = F.col("from").isNotNull() & F.col("to").isNotNull() & F.col("intensity").isNotNull()
    good = records.filter(whole).drop("from_text", "to_text")
    bad = records.filter(~whole).drop("from", "to")
    return good, bad


def require_some(good: DataFrame) -> DataFrame:
    """A collect without a single good record is an error, not an empty load."""
    if good.isEmpty():
        raise ValueError("the feed holds no usable record")
    return good


def flatten(df: DataFrame) -> DataFrame:
    """Document -> flat row. Both index columns copy the one index of the feed."""
    return df.select(
        F.col("from").alias("data_from_dttm"),
        F.col("to").alias("data_to_dttm"),
        F.col("intensity.forecast").alias("forecast_intensity"),
        F.col("intensity.actual").alias("actual_intensity"),
        F.col("intensity.index").alias("index_forecast"),
        F.col("intensity.index").alias("index_actual"),
        F.col("created_at").alias("src_processed_dttm"),
    )
