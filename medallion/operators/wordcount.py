"""Word count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.text import words


def count_words(df: DataFrame, column: str) -> DataFrame:
    """Occurrences of each word, summed within partitions before the shuffle."""
    return (
        df.select(F.explode(words(column)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
