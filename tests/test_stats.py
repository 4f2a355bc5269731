"""Exact quantiles, moments, imputers, binning: edge cases against numpy/pandas semantics."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.functions import scalar as sc
from scorekit.operators import clean as cl
from scorekit.operators import features as fe
from scorekit.operators import profile as pr
from scorekit.operators.stats import exact_quantiles


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(5)
    vals = [float(rnd.randint(0, 50)) for _ in range(1001)] + [None, float("nan"), float("inf")]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(6)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], probs).collect()}
    arr = np.array([v for v in vals if v is not None and math.isfinite(v)])
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(arr, p)), abs=1e-12)


def test_quantile_of_empty_and_one_row(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    got = exact_quantiles(df, ["a", "b"], [0.5]).collect()
    assert [(r["feature"], r["value"]) for r in got] == [("a", 1.0)]


def test_moments_bias_corrected(spark):
    x = [1.0, 2.0, 2.0, 3.0, 7.0, 11.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    r = pr.moments(df, ["x"]).first()
    import pandas as pd
    s = pd.Series(x)
    assert r["skewness"] == pytest.approx(s.skew(), abs=1e-12)
    assert r["kurtosis"] == pytest.approx(s.kurt(), abs=1e-12)
    assert r["var"] == pytest.approx(s.var(), abs=1e-12)


def test_feature_kinds_and_constant_dropper(spark):
    df = spark.createDataFrame([(1, 0, 5.0, None), (1, 1, 6.0, None), (1, 0, 7.0, None)],
                               "c int, b int, m double, e double")
    kinds = {r["feature"]: r["kind"] for r in pr.feature_kinds(df, ["c", "b", "m", "e"]).collect()}
    assert kinds["c"] == "constant" and kinds["b"] == "binary" and kinds["m"] == "few"
    assert set(cl.ConstantDropper(["c", "b", "m", "e"]).fit(df)) == {"c", "e"}


def test_median_imputer_fits_once(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    score = spark.createDataFrame([(None,), (100.0,)], "x double")
    m = cl.MedianImputer(["x"]).fit(train)
    assert sorted(r["x"] for r in m.transform(score).collect()) == [2.0, 100.0]


def test_bins_right_closed_and_outside(spark):
    df = spark.createDataFrame([(0.0,), (1.1,), (1.2,), (10.0,), (11.0,)], "r double")
    got = [r[0] for r in df.select(fe.bin_fixed("r", [0, 1.1, 1.4, 10], default=1)).collect()]
    assert got == [1, 0, 1, 2, 1]
    got2 = [r[0] for r in df.select(fe.bin_fixed("r", [0, 1.1, 1.4, 10], include_lowest=True)).collect()]
    assert got2 == [0, 0, 1, 2, None]


def test_width_binner_matches_pandas_cut(spark):
    import pandas as pd
    vals = [1.0, 2.0, 3.5, 9.0, 10.0, 4.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    b = fe.WidthBinner(["x"], 5).fit(df)
    got = [r["x_e"] for r in b.transform(df, "_e").orderBy("x").collect()]
    want = list(pd.cut(pd.Series(sorted(vals)), bins=5, labels=False))
    assert got == want


def test_quantile_binner_matches_qcut(spark):
    import pandas as pd
    rnd = random.Random(2)
    vals = [float(rnd.randint(0, 30)) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    b = fe.QuantileBinner(["x"], 5).fit(df)
    got = [r["x_q"] for r in b.transform(df, "_q").orderBy("x").collect()]
    want = list(pd.qcut(pd.Series(sorted(vals)), q=5, labels=False, duplicates="drop"))
    assert got == want


def test_row_stats_match_pandas(spark):
    import pandas as pd
    rows = [(1.0, 2.0, 4.0, 8.0), (3.0, 3.0, 3.0, 3.0), (1.0, None, 5.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    st = sc.row_stats(["a", "b", "c", "d"])
    got = df.select(*[e.alias(n) for n, e in st.items()]).collect()
    pdf = pd.DataFrame(rows, columns=list("abcd"))
    for i, r in enumerate(got):
        assert r["row_mean"] == pytest.approx(pdf.iloc[i].mean())
        assert r["row_median"] == pytest.approx(pdf.iloc[i].median())
        assert r["row_std"] == pytest.approx(pdf.iloc[i].std())
        assert r["row_skew"] == pytest.approx(pdf.iloc[i].skew(), abs=1e-9)


def test_last_wins_and_clip_null(spark):
    df = spark.createDataFrame([(150,), (190,), (None,)], "ap int")
    e = sc.last_wins(0, [(F.col("ap") >= 130, 1), (F.col("ap") >= 180, 3)])
    assert [r[0] for r in df.select(e).collect()] == [1, 3, 0]
    assert [r[0] for r in df.select(sc.clip("ap", 160, 180)).collect()] == [160, 180, None]


def test_t_pvalues_known_values(spark):
    tt = spark.createDataFrame([("a", 2.0, 10.0), ("b", -1.0, 30.0), ("c", 0.0, 5.0)],
                               "feature string, t_statistic double, dof double")
    got = {r["feature"]: r["p_value"] for r in pr.t_pvalues(tt).collect()}
    assert got["a"] == pytest.approx(0.0734, abs=1e-4)   # two-sided, t = 2, 10 dof
    assert got["b"] == pytest.approx(0.3253, abs=1e-4)   # t = -1, 30 dof
    assert got["c"] == pytest.approx(1.0, abs=1e-12)


def test_ttest_matches_pooled_formula(spark):
    import pandas as pd
    a = [1.0, 2.0, 3.5, 4.0]
    b = [2.0, 5.0, 6.5, 7.0, 9.0]
    df = spark.createDataFrame([(v, 0) for v in a] + [(v, 1) for v in b], "x double, y int")
    r = pr.ttest(df, ["x"], "y").first()
    sa, sb = pd.Series(a), pd.Series(b)
    sp2 = ((len(a) - 1) * sa.var() + (len(b) - 1) * sb.var()) / (len(a) + len(b) - 2)
    t = (sa.mean() - sb.mean()) / math.sqrt(sp2 * (1 / len(a) + 1 / len(b)))
    assert r["t_statistic"] == pytest.approx(t, abs=1e-12)


def test_selection_with_a_coarse_sketch(spark):
    """Few sketch points: wide enclosures, and groups where the sketch misses are counted in full."""
    import numpy as np
    rng = np.random.default_rng(6)
    rows = [("a", float(v)) for v in rng.normal(size=3000)] + [("b", float(v)) for v in rng.integers(0, 4, 500)] + [("c", 1.5)] * 40 + [("d", 2.0), ("d", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    for accuracy in (3, 30, 10_000):
        got = {(r.g, r.prob): r.value for r in exact_quantiles(df, ["x"], probs, by=["g"], accuracy=accuracy).collect()}
        for g in "abcd":
            v = [x for k, x in rows if k == g and x is not None]
            for p in probs:
                assert abs(got[g, p] - np.quantile(v, p)) < 1e-12, (g, p, accuracy)
        assert len(got) == 24


def test_wide_frames_run_code_that_is_compiled(spark):
    """Sixty computed columns make one generated method too long for HotSpot; a limit of the session's own stays."""
    from scorekit.session import CODE_DEFAULT, CODE_KEY
    cols = [f"c{k}" for k in range(60)]
    df = spark.range(200).selectExpr(*[f"cast((id * {2 * k + 3}) % {17 + k} as double) as c{k}" for k in range(60)])
    before = spark.conf.get(CODE_KEY, CODE_DEFAULT)
    try:
        for found in (pr.feature_kinds, pr.corr_pairs):
            spark.conf.set(CODE_KEY, CODE_DEFAULT)
            found(df, cols)
            assert int(spark.conf.get(CODE_KEY)) == 8000
        spark.conf.set(CODE_KEY, "20000")
        got = {r["feature"]: r["n_unique"] for r in pr.feature_kinds(df, cols).collect()}
        assert spark.conf.get(CODE_KEY) == "20000"
    finally:
        spark.conf.set(CODE_KEY, before)
    assert got == {f"c{k}": len({i * (2 * k + 3) % (17 + k) for i in range(200)}) for k in range(60)}
