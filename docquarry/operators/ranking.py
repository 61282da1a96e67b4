"""One row per key, by an explicit order."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def keep_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order; null keys form one group.

    Spark limits each group to one row *before* the shuffle as well as after it, so a key that
    holds a third of all rows sends one row per map task to its reducer, not the whole group.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
