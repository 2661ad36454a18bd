"""Work spread over tasks."""

from pyspark.sql import functions as F

from fixtures.catalog.registry import raw


def test_raw_tables_are_not_one_task(spark, sf):
    tasks = raw(spark, sf, "raw_left_people").select(F.spark_partition_id().alias("task")).distinct()
    assert tasks.count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
