"""Round trips of sources, sinks and model persistence, and operators no other query calls (IO1-IO8, B22, P13,
J5, F22, L3-L7, E11, U5, X7). Files go to a fresh folder under the shared checkpoint folder."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import cardio as cd
from ..operators import clean as cl
from ..operators import ensemble as ens
from ..operators import features as fe
from ..operators import joins as jn
from ..operators import metrics as met
from ..operators import models as mdl
from ..operators import order
from ..operators import profile as pr
from ..operators import select as sel
from ..session import ensure_checkpoint_dir
from ..sources import io
from ..spec import TableSpec
from . import frames as fr
from . import q_cardio
from .q_contracts import COLS, RN, folded
from .q_contracts import W as W_PATIENT
from .registry import register


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/io-{uuid.uuid4().hex}"


V_SQL = f"WITH v AS ({fr.VOTES_SQL}), s AS ({fr.SCORES_SQL})\n"


@register("io_read_csv", "id bigint, label bigint", V_SQL + "SELECT id, v1 AS label FROM v", ops=("IO1", "IO2"))
def q_read_csv(spark, sf):
    path = io.write_predictions(fr.votes(spark, sf).select("id", F.col("v1").alias("label")), _folder(spark), order_col="id")
    return io.read_table(spark, path, TableSpec("id", "label"), "id long, label int", "csv")


@register("io_file_order", "row_no bigint, id bigint, label bigint",
          V_SQL + "SELECT row_number() OVER (ORDER BY id DESC) - 1 AS row_no, id, v1 AS label FROM v", ops=("IO2", "U5"))
def q_file_order(spark, sf):
    """Several files written in order, read back with the number of each row."""
    v = fr.votes(spark, sf).select("id", F.col("v1").alias("label"))
    path = _folder(spark)
    v.repartitionByRange(7, F.col("id").desc()).sortWithinPartitions(F.col("id").desc()).write.option("header", True).csv(path)
    return io.read_in_order(spark, path, "id long, label int").select("row_no", "id", "label")


@register("io_bucketed_join", "id bigint, a bigint, b bigint", V_SQL + "SELECT x.id, x.v1 AS a, y.v2 AS b FROM v x JOIN v y ON x.id = y.id WHERE y.id % 3 <> 0",
          ops=("J1", "J2", "R2"))
def q_bucketed_join(spark, sf):
    """Two prediction sets stored by id and joined bucket by bucket."""
    return io_bucketed(spark, sf)


def io_bucketed(spark, sf) -> DataFrame:
    v, root = fr.votes(spark, sf), _folder(spark)
    names = [f"scorekit_{uuid.uuid4().hex}" for _ in range(2)]
    io.write_bucketed(v.select("id", F.col("v1").alias("a")), names[0], "id", 4, f"{root}/a")
    io.write_bucketed(v.where("id % 3 <> 0").select("id", F.col("v2").alias("b")), names[1], "id", 4, f"{root}/b")
    a, b = (spark.table(n) for n in names)
    return a.join(b.hint("merge"), "id").select("id", "a", "b")


@register("io_probabilities", "id bigint, prob double", V_SQL + "SELECT id, p AS prob FROM s", ops=("IO3", "IO1"))
def q_probabilities(spark, sf):
    s = fr.scores(spark, sf).withColumnRenamed("p", "prob")
    return io.read_table(spark, io.write_probabilities(s, _folder(spark)))


@register("io_vote_files", "id bigint, label bigint", V_SQL + """, l AS (SELECT id, v1 + v2 + v3 AS n FROM v)
SELECT id, CAST(n >= 2 AS INTEGER) AS label FROM l""", ops=("IO2", "IO4", "B9"))
def q_vote_files(spark, sf):
    """Three prediction sets written, a fourth missing, all listed ones loaded and voted on."""
    v, root = fr.votes(spark, sf), _folder(spark)
    entries = [(io.write_predictions(v.select("id", F.col(c).alias("label")), f"{root}/{c}"), c) for c in ("v1", "v2", "v3")]
    return ens.majority_vote(io.load_prediction_sets(spark, [*entries, (f"{root}/none", "none")]))


@register("io_run_record", "name string, value double", "SELECT 'alpha' AS name, 0.25 AS value UNION ALL SELECT 'depth', 7.0 UNION ALL SELECT "
          "'rows', CAST(count(*) AS DOUBLE) FROM orders UNION ALL SELECT 'rate', 0.1", ops=("IO5", "IO8"))
def q_run_record(spark, sf):
    """A run record overrides the defaults it has; the others and those of a missing file stay."""
    n = fr.table(spark, sf, "orders").count()
    path = io.write_run(spark, {"alpha": 0.25, "rows": n}, _folder(spark))
    got = io.load_params(spark, path, {"alpha": 0.5, "depth": 7, "rows": 0, "rate": 0.1})
    if io.load_params(spark, f"{path}/none", {"rate": 0.1}) != {"rate": 0.1}:
        raise ValueError("defaults lost")
    return spark.createDataFrame([(k, float(v)) for k, v in got.items()], "name string, value double")


@register("io_saved_models", "model string, rows bigint, same bigint",
          W_PATIENT + " UNION ALL ".join(f"SELECT '{m}' AS model, count(*) AS rows, count(*) AS same FROM t"
                                         for m in ("tree", "pipeline", "adaboost", "routed", "scaler", "fill")), ops=("IO6", "M12", "F28", "F20"))
def q_saved_models(spark, sf):
    """Every kind of model scores the same after a save and a load."""
    d, root = folded(spark, sf), _folder(spark)
    first = lambda df, c: df.select("id", F.col(c).alias("a"))
    tree, poly = mdl.tree(max_depth=3)().fit(d), mdl.perceptron([len(COLS), 3, 2], max_iter=5)().fit(d)
    ada = mdl.AdaBoost(depth=2, rounds=2, rate=0.5).fit(d)
    scaler = cl.ZScaler(["ap_lo"]).fit(d)
    fill = cl.MedianImputer(["weight"]).fit(d)
    pairs = {"tree": (tree, lambda m: first(m.transform(d), "prediction")), "pipeline": (poly, lambda m: first(m.transform(d), "prediction")),
             "adaboost": (ada, lambda m: first(m.transform(d), "prob")),
             "routed": ((tree, None), lambda m: first(m[0].transform(d), "prediction")),
             "scaler": (scaler, lambda m: first(m.transform(d), "ap_lo")), "fill": (fill, lambda m: first(m.transform(d), "weight"))}
    out = []
    for name, (model, use) in pairs.items():
        loaded = io.load_model(io.save_model(model, f"{root}/{name}"))
        both = use(model).join(use(loaded).withColumnRenamed("a", "b"), "id")
        out.append(both.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col("a").eqNullSafe(F.col("b"))).alias("same")))
    return reduce(DataFrame.unionByName, out)


@register("io_oof", "model string, id bigint, prob double", V_SQL + "SELECT 'a' AS model, id, p AS prob FROM s UNION ALL SELECT 'b', id, 1 - p FROM s",
          ops=("IO7",))
def q_oof(spark, sf):
    s = fr.scores(spark, sf)
    long = s.select(F.lit("a").alias("model"), "id", F.col("p").alias("prob")).unionByName(s.select(F.lit("b").alias("model"), "id", (1 - F.col("p")).alias("prob")))
    return io.read_table(spark, io.write_oof(long, _folder(spark))).select("model", "id", "prob")


@register("io_thresholds", "id bigint, label bigint, threshold double", V_SQL + " UNION ALL ".join(
    f"SELECT id, CAST(p > {t} AS INTEGER) AS label, {t} AS threshold FROM s" for t in (0.3, 0.5, 0.7)), ops=("B22",))
def q_thresholds(spark, sf):
    return io.read_table(spark, ens.publish_thresholds(fr.scores(spark, sf), "id", "p", [0.3, 0.5, 0.7], _folder(spark))).select(
        "id", "label", F.col("threshold").cast("double"))


@register("io_errors", "id bigint, true_label bigint, predicted_label bigint, prediction_prob double", V_SQL +
          "SELECT id, y AS true_label, CAST(p >= 0.5 AS INTEGER) AS predicted_label, p AS prediction_prob FROM s WHERE y <> CAST(p >= 0.5 AS INTEGER)", ops=("IO9",))
def q_errors(spark, sf):
    s = fr.scores(spark, sf).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    path = io.write_errors(s, _folder(spark), "id", "y", "pred", "p")
    return io.read_table(spark, path, schema="id long, true_label int, predicted_label int, prediction_prob double", fmt="csv")


@register("attach_oof", "id bigint, fold bigint, prob double", W_PATIENT + f""", f AS (SELECT id, ({RN} - 1) % 3 AS fold FROM t)
SELECT t.id, f.fold, CASE WHEN f.fold <> 1 THEN (f.id % 10) / 10.0 END AS prob FROM t LEFT JOIN f USING (id)""", ops=("J5",))
def q_attach_oof(spark, sf):
    """Out-of-fold scores of two of three folds, attached by id: the third has none."""
    d = folded(spark, sf).select("id", "fold")
    oof = d.where("fold <> 1").select("id", ((F.col("id") % 10) / 10.0).alias("prob"))
    return jn.attach_oof(d, oof, "id").select("id", "fold", "prob")


@register("fill_constants", "id bigint, weight double, ap_hi bigint", W_PATIENT +
          "SELECT id, coalesce(weight, 70.0) AS weight, coalesce(ap_hi, 120) AS ap_hi FROM t", ops=("F22", "P13"))
def q_fill(spark, sf):
    from .q_contracts import patient
    p = patient(spark, sf)
    cl.require(p, ["id", "weight", "ap_hi"])
    return cl.fill_constants(p, {"weight": 70.0, "ap_hi": 120, "absent": 1}).select("id", "weight", "ap_hi")


@register("required_columns", "missing string", "SELECT 'missing required columns: [''height'']' AS missing FROM (SELECT count(*) FROM orders)", ops=("P13",))
def q_require(spark, sf):
    try:
        cl.require(fr.votes(spark, sf), ["id", "height"])
    except ValueError as e:
        return spark.createDataFrame([(str(e),)], "missing string")
    raise AssertionError("a missing column was not reported")


CORR = "SELECT feature, corr, row_number() OVER (ORDER BY abs(corr) DESC NULLS LAST, feature) AS place FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(cardio AS DOUBLE)) AS corr FROM t" for c in ("height", "weight", "ap_hi", "ap_lo", "age")) + ")"


def _placed(df: DataFrame, cols) -> DataFrame:
    """Rows of a small sorted frame with the place at which they came."""
    rows = [(*[r[c] for c in cols], k) for k, r in enumerate(df.select(*cols).collect(), 1)]
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in cols)
    return df.sparkSession.createDataFrame(rows, f"{kinds}, place int")


@register("sorted_abs_corr", "feature string, corr double, place bigint", f"WITH t AS ({fr.CARDIO_SQL}) {CORR}", ops=("L3",))
def q_sorted(spark, sf):
    tc = pr.target_corr(fr.cardio(spark, sf), ["height", "weight", "ap_hi", "ap_lo", "age"], "cardio")
    return _placed(order.sort_abs(tc, "corr", tie_col="feature"), ["feature", "corr"])


@register("ordered_ids", "key string, place bigint", """WITH k AS (SELECT DISTINCT source AS key FROM documents UNION ALL SELECT CAST(r_regionkey * 7 AS VARCHAR) FROM region)
SELECT key, row_number() OVER (ORDER BY TRY_CAST(key AS BIGINT) NULLS LAST, key) AS place FROM k""", ops=("L4",))
def q_ordered(spark, sf):
    k = fr.table(spark, sf, "documents").select(F.col("source").alias("key")).distinct().unionByName(
        fr.table(spark, sf, "region").select((F.col("r_regionkey") * 7).cast("string").alias("key")))
    return _placed(order.order_ids(k, "key"), ["key"])


@register("unique_names", "name string, place bigint", """WITH e AS (SELECT event_type AS name, min(event_id) AS first FROM events GROUP BY 1)
SELECT name, place FROM (SELECT name, row_number() OVER (ORDER BY first) AS place FROM e) WHERE place <= 3""", ops=("L5",))
def q_unique(spark, sf):
    """The first three kinds of events in order of appearance (from the first event of each kind)."""
    firsts = fr.table(spark, sf, "events").groupBy("event_type").agg(F.min("event_id").alias("first")).orderBy("first").collect()
    names = order.unique_in_order([n for r in firsts for n in (r["event_type"], firsts[0]["event_type"])], cap=3)
    return spark.createDataFrame([(n, k) for k, n in enumerate(names, 1)], "name string, place int")


@register("largest_order", "o_orderkey bigint, o_totalprice double", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1", ops=("L6",))
def q_largest(spark, sf):
    return order.argmax_row(fr.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@register("first_last_listed", "kind string, o_orderkey bigint", """(SELECT 'large' AS kind, o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
UNION ALL (SELECT 'small', o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5)""", ops=("L1", "L2"))
def q_ends(spark, sf):
    o = fr.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return order.nlargest(o, "o_totalprice", 5, "o_orderkey").select(F.lit("large").alias("kind"), "o_orderkey").unionByName(
        order.nsmallest(o, "o_totalprice", 5, "o_orderkey").select(F.lit("small").alias("kind"), "o_orderkey"))


@register("compared_models", "model string, accuracy double, f1 double", V_SQL + " UNION ALL ".join(
    f"SELECT 'v{k}' AS model, avg(CAST(y = v{k} AS DOUBLE)) AS accuracy, 2.0 * count(*) FILTER (WHERE y = 1 AND v{k} = 1) / "
    f"(2.0 * count(*) FILTER (WHERE y = 1 AND v{k} = 1) + count(*) FILTER (WHERE y <> v{k})) AS f1 FROM v" for k in (1, 2, 3)), ops=("E11", "E1"))
def q_compared(spark, sf):
    v = fr.votes(spark, sf)
    return met.compare_models({c: met.confusion_metrics(v, "y", c) for c in ("v1", "v2", "v3")}).select("model", "accuracy", "f1")


@register("same_order_check", "name string, rows bigint, missing bigint, extra bigint, moved bigint", f"""WITH o AS ({fr.VERSIONS_OLD_SQL}),
a AS (SELECT id, row_number() OVER (ORDER BY id) AS pos FROM o), b AS (SELECT id, row_number() OVER (ORDER BY id % 1000, id) AS pos FROM o)
SELECT 'sorted' AS name, count(*) AS rows, 0 AS missing, 0 AS extra, 0 AS moved FROM a
UNION ALL SELECT 'dealt', count(*), 0, 0, count(*) FILTER (WHERE a.pos <> b.pos) FROM a JOIN b USING (id)""", ops=("U5",))
def q_same_order(spark, sf):
    old = fr.versions(spark, sf)[0]
    a = order.global_rank(old.withColumn("k", F.col("id").cast("double")), "k", "id", descending=False, out_col="pos")
    b = order.global_rank(old.withColumn("k", (F.col("id") % 1000).cast("double")), "k", "id", descending=False, out_col="pos")
    return jn.check_same_ids({"sorted": a.select("id", "pos"), "dealt": b.select("id", "pos")}, "id", order_col="pos")


@register("selection_groups", "grp string, n bigint, names string", f"""WITH t AS ({fr.CARDIO_SQL}), s AS (SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, var_samp({c}) AS var FROM t" for c in ("height", "weight", "ap_hi", "ap_lo", "age")) + """) ORDER BY var DESC LIMIT 4)
SELECT g.grp, count(s.feature) AS n, coalesce(string_agg(s.feature, ',' ORDER BY s.var DESC), '') AS names
FROM (VALUES ('pressure'), ('body'), ('none')) g(grp) LEFT JOIN s ON (g.grp = 'pressure' AND s.feature LIKE 'ap%') OR (g.grp = 'body' AND s.feature NOT LIKE 'ap%')
GROUP BY g.grp""", ops=("X7", "X8"))
def q_groups(spark, sf):
    names = [r["feature"] for r in sel.select_by_variance(fr.cardio(spark, sf), ["height", "weight", "ap_hi", "ap_lo", "age"], 4).collect()]
    rep = sel.selection_report(names, {"pressure": lambda n: n.startswith("ap"), "body": lambda n: not n.startswith("ap"), "none": lambda n: False})
    return spark.createDataFrame([(g, len(v), ",".join(v)) for g, v in rep.items()], "grp string, n int, names string")


@register("select_by_anova", "feature string, f_score double", f"WITH t AS ({fr.CARDIO_SQL}), l AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, cardio AS y FROM t" for c in ("height", "weight", "ap_hi", "ap_lo")) + """),
g AS (SELECT feature, y, count(*) AS n, avg(v) AS m, var_samp(v) AS s FROM l GROUP BY 1, 2),
a AS (SELECT feature, sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS mm, sum((n - 1) * s) AS ssw FROM g GROUP BY 1)
SELECT a.feature, (sum(g.n * (g.m - a.mm) * (g.m - a.mm)) / (max(a.k) - 1)) / (max(a.ssw) / (max(a.n) - max(a.k))) AS f_score
FROM a JOIN g USING (feature) GROUP BY a.feature ORDER BY f_score DESC, a.feature LIMIT 2""", ops=("A16", "X1"))
def q_anova(spark, sf):
    return sel.select_by_anova(fr.cardio(spark, sf), ["height", "weight", "ap_hi", "ap_lo"], "cardio", 2)


# --- D8, D9: scoring frames filled with training medians ------------------------------------

V2_GAPS = ["trestbps", "chol", "oldpeak"]


@register("cardio_compact_filled", q_cardio.COMPACT_OUT, f"WITH t AS ({fr.CARDIO_SQL}), c AS (" + q_cardio.REGISTRY_SQL["cardio_compact"] +
          "), m AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in cd.COMPACT_COLS) + f" FROM c), h AS ({fr.HEART_SQL}), s AS (" +
          q_cardio.REGISTRY_SQL["cardio_compact_score"] + ") SELECT id, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in cd.COMPACT_COLS) + " FROM s, m",
          ops=("D9", "F20"))
def q_compact_filled(spark, sf):
    fill = cd.MedianFill(cd.COMPACT_COLS).fit(cd.cardio_compact(fr.cardio(spark, sf), "train"))
    return fill.transform(cd.cardio_compact(fr.heart(spark, sf), "score"))


@register("column_helpers", "id bigint, f bigint, root double, soft double, key bigint, cleaned double",
          f"WITH t AS ({fr.CARDIO_SQL}) SELECT id, coalesce(CAST(ap_hi AS INTEGER), -1) AS f, sqrt(greatest(CAST(ap_hi - ap_lo AS DOUBLE), 0.0)) AS root, "
          "1 / (1 + exp(-(ap_lo / 100.0 - ap_hi / 100.0))) AS soft, CASE WHEN gluc = 2 THEN 9 ELSE gluc END AS key, "
          "CASE WHEN smoke = 1 THEN NULL ELSE weight END AS cleaned FROM t", ops=("F3", "F8", "F13", "P11"))
def q_helpers(spark, sf):
    c = fr.cardio(spark, sf)
    inf = F.when(F.col("smoke") == 1, F.lit(float("inf"))).otherwise(F.col("weight"))
    return c.select("id", sc.first_present(c, ["absent", "ap_hi"], -1).alias("f"), sc.sqrt_pos(F.col("ap_hi") - F.col("ap_lo")).alias("root"),
                    sc.softmax2(F.col("ap_hi") / 100.0, F.col("ap_lo") / 100.0).alias("soft"), sc.replace_value("gluc", 2, 9).alias("key"),
                    sc.inf_to_null(inf).alias("cleaned"))


@register("joined_predictions", "id string, a bigint, b bigint",
          f"WITH v AS ({fr.VOTES_SQL}) SELECT CAST(a.id AS VARCHAR) AS id, a.v1 AS a, b.v2 AS b FROM v a JOIN v b ON a.id = b.id WHERE a.id % 3 <> 0", ops=("J2",))
def q_joined(spark, sf):
    v = fr.votes(spark, sf)
    return jn.join_predictions(v.where("id % 3 <> 0"), v, "id", "v1", "v2")


@register("looked_up_stats", "id bigint, mean_weight double", f"""WITH t AS ({fr.CARDIO_SQL}), m AS (SELECT gluc, avg(weight) AS m FROM t WHERE gluc < 3 GROUP BY gluc)
SELECT id, coalesce(m, -1.0) AS mean_weight FROM t LEFT JOIN m USING (gluc)""", ops=("J4", "A18"))
def q_looked_up(spark, sf):
    c = fr.cardio(spark, sf)
    stats = pr.group_means(c.where("gluc < 3"), ["gluc"], ["weight"])
    return jn.lookup_stats(c, stats, ["gluc"], {"mean_weight": -1.0}).select("id", "mean_weight")


@register("ids_subtracted", "id bigint", f"SELECT id FROM ({fr.VERSIONS_OLD_SQL}) EXCEPT SELECT id FROM ({fr.VERSIONS_NEW_SQL})", ops=("U3",))
def q_subtracted(spark, sf):
    return jn.id_subtract(*fr.versions(spark, sf), "id")


@register("kept_where", "id bigint, ap_hi bigint", f"WITH t AS ({fr.CARDIO_SQL}) SELECT id, CASE WHEN ap_hi > ap_lo THEN ap_hi ELSE 0 END AS ap_hi FROM t", ops=("F10",))
def q_kept(spark, sf):
    return fr.cardio(spark, sf).select("id", sc.keep_where(F.col("ap_hi") > F.col("ap_lo"), "ap_hi", 0).alias("ap_hi"))


@register("neighbour_values", "id bigint, prev_1 double, next_1 double, prev_2 double, next_2 double", f"""WITH t AS ({fr.CARDIO_SQL})
SELECT id, lag(weight) OVER w AS prev_1, lead(weight) OVER w AS next_1, lag(weight, 2) OVER w AS prev_2, lead(weight, 2) OVER w AS next_2
FROM t WINDOW w AS (PARTITION BY height ORDER BY weight, id)""", ops=("W4",))
def q_neighbours(spark, sf):
    return order.neighbour_window(fr.cardio(spark, sf), "weight", ["height"], 2, ["id"]).select("id", "prev_1", "next_1", "prev_2", "next_2")


@register("mean_deviation", "id bigint, weight_m_diff double", f"WITH t AS ({fr.CARDIO_SQL}), m AS (SELECT avg(weight) AS m FROM t WHERE id % 2 = 0) "
          "SELECT id, weight - m AS weight_m_diff FROM t, m", ops=("F39",))
def q_mean_deviation(spark, sf):
    """The mean of one part of the rows, taken off all of them."""
    c = fr.cardio(spark, sf)
    dev = fe.MeanDeviation("weight")
    return dev.transform(c, dev.fit(c.where("id % 2 = 0"))).select("id", "weight_m_diff")
