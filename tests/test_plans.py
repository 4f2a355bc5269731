"""Plan-level guarantees: counted broadcasts fall back to a shuffle join, the union guard keeps
grouped results right, votes use a single shuffle."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorekit.operators import ensemble as ens
from scorekit.operators import knn
from scorekit.operators.joins import sized_join
from scorekit.plans import frames as fr
from scorekit.plans import q_scale  # noqa: F401
from scorekit.plans.registry import REGISTRY
from scorekit.session import guard_union_partitioning

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sized_join_falls_back_to_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k").withColumn("v", F.lit(1))
        assert "BroadcastHashJoin" in _plan(sized_join(big, small, "k", max_bytes=1000)) or \
            "BroadcastExchange" in _plan(sized_join(big, small, "k", max_bytes=1000))
        joined = sized_join(big, small, "k", max_bytes=100)
        assert "BroadcastExchange" not in _plan(joined)
        assert joined.where(F.col("v").isNotNull()).count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_union_of_partitioned_inputs_groups_once(spark):
    guard_union_partitioning(spark)
    w = Window.partitionBy("g").orderBy("x")
    parts = [spark.range(200).select((F.col("id") % 7).alias("g"), F.col("id").alias("x"), F.lit(i).alias("src"))
             .withColumn("r", F.row_number().over(w)) for i in range(4)]
    u = reduce(DataFrame.unionByName, parts).groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    rows = u.collect()
    assert len(rows) == 7 and sum(r["n"] for r in rows) == 800


def test_majority_vote_single_shuffle(spark):
    lv = ens.long_votes(fr.votes(spark, SF_SMALL), "id", fr.VOTE_SETS)
    plan = _plan(ens.majority_vote(lv))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan


def test_mutual_info_buckets_query_has_many_buckets(spark, monkeypatch):
    seen, plain = [], knn.add_group_value_bucket

    def watched(*args, **kw):
        out = plain(*args, **kw)
        seen.append(out[1])
        return out
    monkeypatch.setattr(knn, "add_group_value_bucket", watched)
    got = {r.feature: r.mi for r in REGISTRY["mutual_info_knn_buckets"].build(spark, SF_SMALL).collect()}
    assert len(seen) == 1 and seen[0] > 1
    want = {r.feature: r.mi for r in REGISTRY["mutual_info_knn"].build(spark, SF_SMALL).collect()}
    assert seen[1] == 1 and got.keys() == want.keys()
    assert all(abs(got[f] - want[f]) < 1e-9 for f in want)


def test_bucketed_tables_join_without_a_shuffle(spark):
    from scorekit.plans.q_io import io_bucketed
    joined = io_bucketed(spark, SF_SMALL)
    assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
    assert joined.count() > 100


def test_file_order_shuffles_no_row(spark):
    import uuid

    from scorekit.session import ensure_checkpoint_dir
    from scorekit.sources import io
    path = f"{ensure_checkpoint_dir(spark)}/order-{uuid.uuid4().hex}"
    spark.range(1000).select("id", (F.col("id") * 7 % 1000).alias("v")).repartitionByRange(5, "id").sortWithinPartitions("id").write.csv(path, header=True)
    with_no = io.read_in_order(spark, path, "id long, v long")
    assert with_no.where("row_no <> id").count() == 0 and with_no.count() == 1000
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")  # several slices a file, several files a task
    try:
        assert io.read_in_order(spark, path, "id long, v long").where("row_no <> id").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_selection_gathers_a_small_share(spark):
    """Only the enclosures of the wanted ranks are counted value by value."""
    from scorekit.operators import stats
    seen, plain = [], stats.prefix_sum

    def watched(df, *args, **kw):
        seen.append(df.count())
        return plain(df, *args, **kw)
    stats.prefix_sum = watched
    try:
        got = {r.prob: r.value for r in stats.exact_quantiles(spark.range(100_000).select((F.col("id") * 7919 % 100_000).cast("double").alias("x")), ["x"], [0.01, 0.5]).collect()}
    finally:
        stats.prefix_sum = plain
    assert got == {0.01: 999.99, 0.5: 49999.5} and len(seen) == 1 and seen[0] < 200
