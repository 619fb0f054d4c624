from obsvar.operators.numbering import assign_index, rank_in_key, running_start
from pyspark.sql import functions as F

from .conftest import rows


def test_assign_index_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("key")).repartition(5)
    got = rows(assign_index(df, ["key"], "obs_idx"))
    assert sorted(got) == [(i, i) for i in range(1000)]


def test_running_start_crosses_buckets(spark):
    sizes = [(i, i % 4) for i in range(50)]
    df = spark.createDataFrame(sizes, "r bigint, n bigint")
    want, total = [], 0
    for r, n in sizes:
        want.append((r, n, total))
        total += n
    assert rows(running_start(df, "r", "n", "start", bucket=7), "r") == want


def test_rank_in_key_splits_a_hot_key(spark):
    df = spark.createDataFrame(
        [("hot" if i % 3 else f"k{i}", i) for i in range(300)], "k string, i bigint"
    )
    seen, want = {}, []
    for k, i in sorted(((r.k, r.i) for r in df.collect()), key=lambda x: x[1]):
        want.append((k, i, seen.setdefault(k, 0)))
        seen[k] += 1
    assert rows(rank_in_key(df, ["k"], "i", "rank", bucket=16), "i") == want
