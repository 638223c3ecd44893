"""distributed_ntile must equal the SQL window NTILE on a total order."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from larchmart.operators.ranking import distributed_ntile, global_rank


@pytest.mark.parametrize("n_rows", [0, 1, 4, 5, 6, 37, 1003])
def test_matches_window_ntile(spark, n_rows):
    # heavy ties in the measure; the id makes the order total
    df = spark.range(n_rows).select(F.col("id").alias("cid"), (F.col("id") * 7 % 5).alias("v"))
    order = [F.col("v").desc(), F.col("cid").asc()]
    ours = distributed_ntile(df, 5, order, "tile", partitions=4)
    ref = df.withColumn("ref", F.ntile(5).over(Window.orderBy(*order)))
    got = ours.join(ref, ["cid", "v"]).where(F.col("tile") != F.col("ref")).count()
    assert ours.count() == n_rows and got == 0


def test_global_rank_is_dense_and_complete(spark):
    df = spark.range(500).select((F.col("id") % 13).alias("k"), F.col("id"))
    r = global_rank(df, [F.col("k"), F.col("id")], partitions=7)
    stats = r.agg(F.min("_rank"), F.max("_rank"), F.countDistinct("_rank"), F.max("_total")).first()
    assert tuple(stats) == (1, 500, 500, 500)
