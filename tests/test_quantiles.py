from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import aggregates as A


def test_settled_quantiles_are_exact_where_the_sketch_is_not(spark):
    values = spark.range(0, 60_000, 1, 12).select(((F.col("id") * 7919) % 60_000 + 1).cast("double").alias("v"))
    sketch = A.percentile_bounds(values, "v", accuracy=300).first()
    assert (sketch["low"], sketch["high"]) != (90.0, 59_910.0)
    settled = A.percentile_bounds(values, "v", accuracy=300, settled=True).first()
    assert (settled["low"], settled["high"]) == (90.0, 59_910.0)


def test_settled_quantiles_of_few_and_equal_values(spark):
    for given in ([1], [1, 1, 1], [3, 1, 2], [None, 4], [5] * 99 + [7], []):
        rows = spark.createDataFrame([(v,) for v in given], "v int")
        for q in ({"low": 0.0015, "high": 0.9985}, {"low": 0.0, "high": 1.0}, {"low": 0.5, "high": 0.5}):
            assert A.settled_quantiles(rows, "v", q, 50).collect() == A.exact_quantiles(rows, "v", q).collect()
