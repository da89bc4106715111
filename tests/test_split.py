from pyspark.sql import functions as F

from retailstar.operators.split import label_split, split_exact


def test_exact_split_sizes_disjoint_complete_repeatable(spark):
    df = spark.range(0, 10).select(F.col("id").cast("int").alias("id"),
                                   (F.col("id") * 3).cast("string").alias("s"))
    a, b = split_exact(df, 0.2, seed=1)
    ra, rb = {tuple(r) for r in a.collect()}, {tuple(r) for r in b.collect()}
    assert len(ra) == 2 and len(rb) == 8
    assert not (ra & rb)
    assert ra | rb == {tuple(r) for r in df.collect()}
    a2, _ = split_exact(df, 0.2, seed=1)
    assert {tuple(r) for r in a2.collect()} == ra


def test_split_of_copies_keeps_counts(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(2,)] * 4, "v int")
    out = label_split(df, 0.5, seed=2)
    assert out.filter("part = 'sample'").count() == 5
    assert out.count() == 10
