"""Catalogued, ``datestr``-partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.landing import DAY


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def partition_keys(spark: SparkSession, table: str, with_null: bool = False) -> DataFrame:
    """Distinct ``datestr`` of a table; NULL, for rows without a day, only ``with_null``.

    Comes from the catalog, which costs the number of partitions and not the
    number of rows. A table that is not partitioned by day is scanned instead.
    """
    columns = spark.catalog.listColumns(table)
    if any(c.name == DAY and c.isPartition for c in columns):
        listed = spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": table})
        key = F.regexp_extract("partition", rf"(?:^|/){DAY}=(\d+)", 1)
        keys = listed.select(key.try_cast("int").alias(DAY))
    else:
        keys = spark.table(table).select(DAY)
    return (keys if with_null else keys.where(F.col(DAY).isNotNull())).distinct()
