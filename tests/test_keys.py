from pyspark.sql import Window
from pyspark.sql import functions as F

from retailstar.operators import keys
from retailstar.operators.dedup import distinct_rows, duplicate_count, survivor
from retailstar.operators.keys import dense_number, map_ids, numbered_with_total


def _reference_numbers(df, order):
    return sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(
        Window.orderBy(*order))).collect())


def test_distributed_numbering_matches_global_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("a"),
                                     (F.col("id") % 13).alias("b"))
    got, n = numbered_with_total(df, ["b", "a"], "rn", partitions=7)
    assert n == 5000
    assert sorted(tuple(r) for r in got.collect()) == _reference_numbers(df, ["b", "a"])


def test_row_order_does_not_matter(spark):
    # many copies and ties in the order column; the second run sees the rows in another order
    df = spark.range(0, 2000).select((F.col("id") % 17).alias("k"), (F.col("id") % 51).alias("v"))
    def numbers(d, ranges):
        out = {}
        for r in dense_number(d, ["k"], "rn", partitions=ranges).collect():
            out.setdefault((r.k, r.v), []).append(r.rn)
        return {key: sorted(v) for key, v in out.items()}
    first = numbers(df.repartition(3), 4)
    assert first == numbers(df.orderBy(F.rand(5)).repartition(7), 6)
    assert sorted(n for v in first.values() for n in v) == list(range(1, 2001))


def test_numbering_of_nothing_and_of_nulls(spark):
    empty = spark.createDataFrame([], "k int, s string")
    assert dense_number(empty, ["k"], "rn").count() == 0
    df = spark.createDataFrame([(None, "b"), (1, None), (None, None), (1, None)], "k int, s string")
    assert sorted((r.rn, r.k, r.s) for r in dense_number(df, ["k"], "rn").collect()) == [
        (1, None, None), (2, None, "b"), (3, 1, None), (4, 1, None)]


def test_temporary_tables_go_when_released(spark):
    import glob
    from retailstar import session
    got = dense_number(spark.range(10), ["id"], "rn")
    kept = session.checkpoint_dir(spark)
    assert got.count() == 10 and glob.glob(f"{kept}/numbered-*")
    session.release_temporary(spark)
    assert not glob.glob(f"{kept}/numbered-*") and not glob.glob(f"{kept}/to-number-*")


def test_hot_group_of_identical_rows_is_spread(spark):
    # a third of all rows are copies of one row
    hot = spark.range(0, 3000).select(F.lit(1).alias("x"))
    rest = spark.range(0, 6000).select((F.col("id") + 2).alias("x"))
    df = hot.unionByName(rest)
    got, n = numbered_with_total(df, ["x"], "rn", partitions=6)
    assert n == 9000
    numbers = sorted(r[0] for r in got.select("rn").collect())
    assert numbers == list(range(1, 9001))
    # the copies took the first 3000 numbers
    assert got.filter("x = 1").agg(F.max("rn")).first()[0] == 3000
    # the copies were written by more than one range (no single hot task)
    assert got.filter("x = 1").select(F.input_file_name()).distinct().count() > 1


def test_numbering_has_no_single_partition_exchange(spark, capsys):
    df = spark.range(0, 1000).select((F.col("id") % 10).alias("k"), "id")
    got = dense_number(df, ["k", "id"], "rn")
    got.explain("formatted")
    plan = capsys.readouterr().out
    assert "SinglePartition" not in plan and "Window" not in plan


def test_survivor_prefers_database_row(spark):
    df = spark.createDataFrame([(None, "Canada", None), (7, "Canada", 30), (9, "Canada", 31),
                                (None, "Peru", None)], "id long, name string, pop long")
    out = survivor(df, ["name"], [F.col("id").isNull(), F.coalesce("id", F.lit(0))])
    assert sorted((tuple(r) for r in out.collect()), key=str) == [(7, "Canada", 30), (None, "Peru", None)]


def test_map_ids_deduplicates_and_misses_are_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",)], "name string")
    mapping = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "name string, id long")
    out = map_ids(df, mapping, ["name"], ["name"], "id", "fk")
    assert sorted((tuple(r) for r in out.collect()), key=str) == [("a", 1), ("b", 3), ("z", None)]


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1, "x")] * 3 + [(2, "y")], "a int, b string")
    assert duplicate_count(df).first()[0] == 2
    assert distinct_rows(df).count() == 2


def test_planner_decides_by_written_size(spark, tmp_path, capsys):
    from retailstar.operators.joins import lookup_join
    big, small = str(tmp_path / "big"), str(tmp_path / "small")
    # few rows, many bytes: 20,000 rows of 2 KB that do not compress
    spark.range(20_000).select("id", F.concat_ws("", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512)
                                                       for i in range(16)]).alias("s")).write.parquet(big)
    spark.range(10).write.parquet(small)
    left = spark.range(1000)
    lookup_join(left, spark.read.parquet(small), "id").explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out
    lookup_join(left, spark.read.parquet(big), "id").explain()
    out = capsys.readouterr().out
    assert "SortMergeJoin" in out and "BuildRight" not in out


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from retailstar.session import is_local
    assert is_local("local") and is_local("local[8]")
    assert not is_local("local-cluster[3,2,1024]") and not is_local("yarn") and not is_local("spark://h:7077")


def test_ranges_follow_the_bytes_and_are_bounded():
    from retailstar.operators import keys as K
    assert K.ranges_for(0, 8) == 1 and K.ranges_for(3 << 20, 8) == 3 and K.ranges_for(1 << 30, 8) == 8
    assert K.ranges_for(100 << 30, 200) == 400 and K.ranges_for(100 << 40, 200) == K.MAX_RANGES


def test_numbering_starts_no_python_worker(spark, monkeypatch):
    # the offsets go to the executors as an Arrow table, not through an RDD of Python rows
    def refused(*a, **k):
        raise AssertionError("an RDD of Python rows")
    monkeypatch.setattr(spark.sparkContext, "parallelize", refused)
    monkeypatch.setattr(type(spark), "_createFromLocal", refused, raising=False)
    df = spark.range(0, 500).select((F.col("id") * 7 % 503).alias("a"))
    assert sorted(tuple(r) for r in dense_number(df, ["a"], "rn", partitions=5).collect()) == _reference_numbers(df, ["a"])
    assert dense_number(df.where("a < 0"), ["a"], "rn").count() == 0
