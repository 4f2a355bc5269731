"""Exact global order with value buckets must equal a plain global window, whatever the
partitioning and bucket count."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from scorekit.operators.order import global_rank, hash_rank, prefix_sum, top_k


def _frame(spark, n=3000, parts=7, seed=1):
    rnd = random.Random(seed)
    rows = [(i, float(rnd.randint(0, 400)), rnd.randint(0, 1)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, v double, g int").repartition(parts)


def test_prefix_sum_matches_window_many_buckets(spark):
    df = _frame(spark)
    agg = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    got = prefix_sum(agg, "v", ["c"], part_cols=["g"], rows_per_bucket=50)  # forces many buckets
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    want = agg.withColumn("want", F.sum("c").over(w))
    bad = got.join(want, ["g", "v"]).where(F.col("cum_c") != F.col("want")).count()
    assert bad == 0


def test_prefix_sum_descending_exclusive(spark):
    df = _frame(spark, n=500)
    agg = df.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    got = prefix_sum(agg, "v", ["c"], descending=True, inclusive=False, rows_per_bucket=20)
    w = Window.orderBy(F.col("v").desc()).rowsBetween(Window.unboundedPreceding, -1)
    want = agg.withColumn("want", F.coalesce(F.sum("c").over(w), F.lit(0)))
    assert got.join(want, "v").where(F.col("cum_c") != F.col("want")).count() == 0


def test_hash_rank_partition_invariant(spark):
    base = _frame(spark, n=800, parts=1)
    a = hash_rank(base, "id", 42, by=["g"]).select("id", F.col("rank").alias("a"))
    b = hash_rank(base.repartition(200), "id", 42, by=["g"]).select("id", F.col("rank").alias("b"))
    j = a.join(b, "id")
    assert j.count() == 800
    assert j.where(F.col("a") != F.col("b")).count() == 0
    # ranks are 1..n_g inside each class
    r = hash_rank(base, "id", 42, by=["g"]).groupBy("g").agg(F.min("rank"), F.max("rank"), F.count(F.lit(1))).collect()
    for row in r:
        assert row[1] == 1 and row[2] == row[3]


def test_global_rank_and_top_k(spark):
    df = _frame(spark, n=300)
    r = global_rank(df, "v", "id").orderBy("rank").collect()
    vals = [(x["v"], x["id"]) for x in r]
    assert vals == sorted(vals, key=lambda t: (-t[0], t[1]))
    top = [x["id"] for x in top_k(df, "v", "id", 10).collect()]
    assert top == [x["id"] for x in r[:10]]
    big = [x["id"] for x in top_k(df, "v", "id", 20, small_k=5).orderBy(F.col("v").desc(), "id").collect()]
    assert big == [x["id"] for x in r[:20]]


def test_group_buckets_split_each_group(spark):
    """Two groups with very different value ranges: each is split by its own cut points."""
    from scorekit.operators.order import add_group_value_bucket
    rows = [("small", i / 1e6) for i in range(2000)] + [("large", float(i * 1000)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double")
    b, nb = add_group_value_bucket(df, "v", "b", ["g"], rows_per_bucket=200)
    sizes = b.groupBy("g", "b").count().collect()
    assert nb >= 10
    assert max(r["count"] for r in sizes) <= 400
    for g in ("small", "large"):
        assert len([r for r in sizes if r["g"] == g]) >= 5
    got = prefix_sum(df.withColumn("c", F.lit(1)), "v", ["c"], part_cols=["g"], rows_per_bucket=200)
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("c", F.lit(1)).withColumn("want", F.sum("c").over(w))
    assert got.join(want, ["g", "v"]).where(F.col("cum_c") != F.col("want")).count() == 0


def test_many_buckets_are_cut_in_levels(spark, monkeypatch):
    """A row meets a bounded number of cuts at a time, however many buckets its group has."""
    from scorekit.operators import order
    met, plain = [], order._bisect
    monkeypatch.setattr(order, "_bisect", lambda cuts, key, most: met.append(most) or plain(cuts, key, most))
    rows = [("a", float((i * 7919) % 6000 % 5000)) for i in range(6000)] + [("b", float(i)) for i in range(3)] + [("a", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    b, nb = order.add_group_value_bucket(df, "v", "b", ["g"], rows_per_bucket=4)
    got = [(r.b, r.v) for r in b.collect() if r.g == "a" and r.v is not None]
    assert nb > 1000 and met and max(met) <= order._CUTS_AT_ONCE
    by_value = sorted(got, key=lambda x: (x[1], x[0]))
    assert len(got) == 6000 and by_value == sorted(got)  # monotone
    assert len({v: k for k, v in got}) == len(set(got))  # equal values in one bucket
    assert len({k for k, _ in got}) > 700 and {r.b for r in b.collect() if r.g != "a"} == {0.0}
