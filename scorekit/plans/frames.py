"""Base frames derived from the driver tables, built by the same expressions in Spark and in SQL.

Each frame has a Spark builder ``(spark, sf_dir) -> DataFrame`` and an SQL text usable as a CTE
in the DuckDB oracle (the driver registers every table as a view). Only the columns a frame needs
are read, so the Parquet scan prunes the rest and pushes filters down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _i(cond):
    return cond.cast("int")


# --- votes: four 0/1 prediction sets and a label per order ---------------------------------

VOTE_SETS = ["v1", "v2", "v3", "v4"]


def votes(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        _i(F.col("o_orderstatus") == "F").alias("y"),
        _i(F.col("o_totalprice") >= 250000).alias("v1"),
        _i(F.col("o_orderkey") % 3 == 0).alias("v2"),
        _i(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("v3"),
        _i(F.col("o_custkey") % 2 == 0).alias("v4"),
    )


VOTES_SQL = """SELECT o_orderkey AS id,
  CAST(o_orderstatus = 'F' AS INTEGER) AS y,
  CAST(o_totalprice >= 250000 AS INTEGER) AS v1,
  CAST(o_orderkey % 3 = 0 AS INTEGER) AS v2,
  CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS v3,
  CAST(o_custkey % 2 = 0 AS INTEGER) AS v4
FROM orders"""

LONG_VOTES_SQL = " UNION ALL ".join(
    f"SELECT id, '{c}' AS model, {i + 1} AS ordinal, {c} AS label FROM votes" for i, c in enumerate(VOTE_SETS))


# --- scores: a probability-like score with real ties, a label and a group ------------------

def scores(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        (F.col("value") / (F.col("value") + 35.0)).alias("p"),
        _i(F.col("event_type").isin("purchase", "signup")).alias("y"),
        F.col("user_id").alias("grp"),
    )


SCORES_SQL = """SELECT event_id AS id, value / (value + 35.0) AS p,
  CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS y, user_id AS grp
FROM events"""


# --- sentinel: three behaviour columns where 999 means "not observed" ----------------------

SENTINEL_COLS = ["s1", "s2", "s3"]


def sentinel(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("id"),
        F.when((k % 25 == 0) | (F.col("p_size") % 10 == 0), F.lit(999)).otherwise(F.col("p_size")).alias("s1"),
        F.when(k % 25 == 0, F.lit(999)).otherwise((k % 7).cast("int")).alias("s2"),
        F.when((k % 25 == 0) | (k % 11 == 0), F.lit(999)).otherwise((k % 5).cast("int")).alias("s3"),
        F.col("p_retailprice").alias("meta"),
        _i(F.col("p_size") > 25).alias("y"),
    )


SENTINEL_SQL = """SELECT p_partkey AS id,
  CASE WHEN p_partkey % 25 = 0 OR p_size % 10 = 0 THEN 999 ELSE p_size END AS s1,
  CASE WHEN p_partkey % 25 = 0 THEN 999 ELSE CAST(p_partkey % 7 AS INTEGER) END AS s2,
  CASE WHEN p_partkey % 25 = 0 OR p_partkey % 11 = 0 THEN 999 ELSE CAST(p_partkey % 5 AS INTEGER) END AS s3,
  p_retailprice AS meta,
  CAST(p_size > 25 AS INTEGER) AS y
FROM part"""


# --- cardio: the Round 2 training schema, derived from orders ------------------------------

CARDIO_COLS = ["age", "gender", "height", "weight", "ap_hi", "ap_lo", "cholesterol", "gluc",
               "smoke", "alco", "active"]


def cardio(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        k.alias("id"),
        (10000 + (k * 37) % 15000).cast("int").alias("age"),
        (1 + c % 2).cast("int").alias("gender"),
        (130 + k % 95).cast("int").alias("height"),
        (40 + (k * 7) % 120).cast("double").alias("weight"),
        (60 + (k * 13) % 200).cast("int").alias("ap_hi"),
        (40 + (k * 11) % 100).cast("int").alias("ap_lo"),
        (1 + (k + c) % 3).cast("int").alias("cholesterol"),
        (1 + (k * 7 + c) % 3).cast("int").alias("gluc"),
        _i(k % 4 == 0).alias("smoke"),
        _i(k % 6 == 0).alias("alco"),
        _i(k % 5 != 0).alias("active"),
        _i(F.col("o_orderstatus") == "F").alias("cardio"),
    )


CARDIO_SQL = """SELECT o_orderkey AS id,
  CAST(10000 + (o_orderkey * 37) % 15000 AS INTEGER) AS age,
  CAST(1 + o_custkey % 2 AS INTEGER) AS gender,
  CAST(130 + o_orderkey % 95 AS INTEGER) AS height,
  CAST(40 + (o_orderkey * 7) % 120 AS DOUBLE) AS weight,
  CAST(60 + (o_orderkey * 13) % 200 AS INTEGER) AS ap_hi,
  CAST(40 + (o_orderkey * 11) % 100 AS INTEGER) AS ap_lo,
  CAST(1 + (o_orderkey + o_custkey) % 3 AS INTEGER) AS cholesterol,
  CAST(1 + (o_orderkey * 7 + o_custkey) % 3 AS INTEGER) AS gluc,
  CAST(o_orderkey % 4 = 0 AS INTEGER) AS smoke,
  CAST(o_orderkey % 6 = 0 AS INTEGER) AS alco,
  CAST(o_orderkey % 5 <> 0 AS INTEGER) AS active,
  CAST(o_orderstatus = 'F' AS INTEGER) AS cardio
FROM orders"""


# --- heart: the Round 2 scoring schema, derived from customer ------------------------------

HEART_COLS = ["age", "sex", "cp", "trestbps", "chol", "fbs", "restecg", "thalach", "exang",
              "oldpeak", "slope", "ca", "thal"]


def heart(spark, sf_dir) -> DataFrame:
    cu = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return cu.select(
        k.alias("id"),
        (29 + k % 50).cast("int").alias("age"),
        (k % 2).cast("int").alias("sex"),
        (k % 4).cast("int").alias("cp"),
        (95 + (k * 7) % 100).cast("int").alias("trestbps"),
        (130 + (k * 11) % 250).cast("int").alias("chol"),
        _i(k % 6 == 0).alias("fbs"),
        (k % 3).cast("int").alias("restecg"),
        (80 + (k * 13) % 120).cast("int").alias("thalach"),
        _i(k % 3 == 0).alias("exang"),
        ((k % 40) / 10.0).alias("oldpeak"),
        (k % 3).cast("int").alias("slope"),
        (k % 4).cast("int").alias("ca"),
        (k % 4).cast("int").alias("thal"),
    )


HEART_SQL = """SELECT c_custkey AS id,
  CAST(29 + c_custkey % 50 AS INTEGER) AS age,
  CAST(c_custkey % 2 AS INTEGER) AS sex,
  CAST(c_custkey % 4 AS INTEGER) AS cp,
  CAST(95 + (c_custkey * 7) % 100 AS INTEGER) AS trestbps,
  CAST(130 + (c_custkey * 11) % 250 AS INTEGER) AS chol,
  CAST(c_custkey % 6 = 0 AS INTEGER) AS fbs,
  CAST(c_custkey % 3 AS INTEGER) AS restecg,
  CAST(80 + (c_custkey * 13) % 120 AS INTEGER) AS thalach,
  CAST(c_custkey % 3 = 0 AS INTEGER) AS exang,
  (c_custkey % 40) / 10.0 AS oldpeak,
  CAST(c_custkey % 3 AS INTEGER) AS slope,
  CAST(c_custkey % 4 AS INTEGER) AS ca,
  CAST(c_custkey % 4 AS INTEGER) AS thal
FROM customer"""


# --- numeric: lineitem measures with a class (no unique key: aggregates only) --------------

NUMERIC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def numeric(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(*NUMERIC_COLS, _i(F.col("l_returnflag") == "R").alias("y"),
                     F.col("l_returnflag").alias("flag"))


NUMERIC_SQL = """SELECT l_quantity, l_extendedprice, l_discount, l_tax,
  CAST(l_returnflag = 'R' AS INTEGER) AS y, l_returnflag AS flag
FROM lineitem"""


# --- docs: documents with labels ------------------------------------------------------------

def docs(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "inner")


DOCS_SQL = """SELECT d.doc_id, d.n_chars, d.lang, d.source, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


# --- vectors: 64-d embeddings with a 0-9 label ---------------------------------------------

def vectors(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    F.col("embedding").cast("array<double>").alias("embedding"),
                    F.col("label"))


# --- versions: two versions of the order id list ---------------------------------------------

def versions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return o.where(F.col("id") % 17 != 0), o.where(F.col("id") % 19 != 0)


VERSIONS_OLD_SQL = "SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 17 <> 0"
VERSIONS_NEW_SQL = "SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 19 <> 0"
