"""Global order that does not depend on how often a value occurs."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = "__spread"


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` sorted by ``columns``, ascending, over all its partitions.

    As ``orderBy`` but for equal rows: those would all go to one sort
    partition, and here the number of the input partition splits them further.
    """
    return (
        df.withColumn(_SPREAD, F.spark_partition_id())
        .repartitionByRange(*columns, _SPREAD)
        .sortWithinPartitions(*columns)
        .drop(_SPREAD)
    )
