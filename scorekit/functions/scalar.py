"""Column functions (F1-F17, P10-P12). All are built-in Spark expressions: codegen, no Python per row."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name) -> Column:
    if isinstance(name, Column):
        return name
    return F.col("`" + name.replace("`", "``") + "`")


# F1 / F2
def mul(a, b) -> Column:
    return col(a) * col(b)


def add(a, b) -> Column:
    return col(a) + col(b)


def sub(a, b) -> Column:
    return col(a) - col(b)


def safe_ratio(a, b, eps: float = 1e-8) -> Column:
    """a / (b + eps); a zero denominator after the epsilon gives null instead of an ANSI error."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double") + F.lit(eps))


# F3 / F4
def unary(c, kind: str) -> Column:
    x = col(c).cast("double")
    if kind == "log1p_abs":
        return F.log1p(F.abs(x))
    if kind == "log2_abs1":
        return F.log2(F.abs(x) + 1)
    if kind == "sqrt_abs":
        return F.sqrt(F.abs(x))
    if kind == "square":
        return x * x
    if kind == "cube":
        return x * x * x
    if kind == "sin":
        return F.sin(x)
    if kind == "cos":
        return F.cos(x)
    raise ValueError(kind)


def log1p_pos(c) -> Column:
    return F.log1p(F.greatest(col(c).cast("double"), F.lit(0.0)))


def sqrt_pos(c) -> Column:
    return F.sqrt(F.greatest(col(c).cast("double"), F.lit(0.0)))


# F5
def age_years(c, divisor: float = 365.0, floor: bool = False) -> Column:
    x = col(c).cast("double") / divisor
    return F.floor(x).cast("long") if floor else x


# F6 / F7 / F15
def clip(c, lo=None, hi=None) -> Column:
    """Null-safe clip (``greatest``/``least`` would skip a null input)."""
    x = col(c)
    out = x
    if lo is not None:
        out = F.when(out < lo, F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > hi, F.lit(hi)).otherwise(out)
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def between(c, lo, hi) -> Column:
    return col(c).between(lo, hi)


def max_const(c, v) -> Column:
    return F.when(col(c).isNull(), F.lit(None)).otherwise(F.greatest(col(c), F.lit(v)))


# F8
def replace_value(c, old, new) -> Column:
    return F.when(col(c) == old, F.lit(new) if not isinstance(new, Column) else new).otherwise(col(c))


def inf_to_null(c) -> Column:
    x = col(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == math.inf), F.lit(None).cast("double")).otherwise(x)


# F9
def map_codes(c, mapping: dict, default=None) -> Column:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    out = m[col(c)]
    return F.coalesce(out, F.lit(default)) if default is not None else out


# F10 / F11 / F12
def keep_where(cond: Column, c, other) -> Column:
    return F.when(cond, col(c)).otherwise(F.lit(other))


def last_wins(default, rules) -> Column:
    """Staged assignment where a later rule overrides an earlier one: a ``when`` chain in reverse."""
    expr = None
    for cond, value in reversed(list(rules)):
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


def flag(cond: Column) -> Column:
    """Boolean -> 0/1, with null (comparison against a missing value) -> 0 as pandas gives False."""
    return F.coalesce(cond.cast("int"), F.lit(0))


# F13
def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(c).cast("double")))


def softmax2(a, b) -> Column:
    """Probability of the second class from two logits."""
    return sigmoid(col(b) - col(a))


# F14
def text_key(c) -> Column:
    return F.lower(col(c).cast("string"))


def starts_with(c, s: str) -> Column:
    return col(c).cast("string").startswith(s)


# P10 / P11
def to_number(c, default=None) -> Column:
    x = col(c).cast("string").try_cast("double")
    return F.coalesce(x, F.lit(default)) if default is not None else x


def first_present(df: DataFrame, names, default=None) -> Column:
    """The first of ``names`` the frame has, else a constant."""
    have = set(df.columns)
    for n in names:
        if n in have:
            return col(n)
    return F.lit(default)


# F16 / F17
def row_stats(cols) -> dict:
    """Row-wise sum, mean, sample std, median, min, max, range, skew (G1), kurtosis (G2) over
    ``cols``; nulls are skipped as in pandas.

    Plain column arithmetic (whole-stage codegen, the mean is a shared subexpression); only the
    median sorts, with the built-in ``array_sort`` that puts nulls last."""
    xs = [col(c).cast("double") for c in cols]
    n = reduce(lambda a, b: a + b, [F.when(x.isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0)) for x in xs])
    s = reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0.0)) for x in xs])
    mean = F.when(n > 0, s / n)

    def central(power):
        return reduce(lambda a, b: a + b, [F.coalesce(F.pow(x - mean, power), F.lit(0.0)) for x in xs])

    m2, m3, m4 = central(2), central(3), central(4)
    srt = F.array_sort(F.array(*xs))
    ni = n.cast("int")
    mid = F.floor((n - 1) / 2).cast("int")
    median = F.when(ni == 0, F.lit(None)).when(ni % 2 == 1, F.element_at(srt, mid + 1)).otherwise(
        (F.element_at(srt, mid + 1) + F.element_at(srt, mid + 2)) / 2)
    var = F.when(n > 1, m2 / (n - 1))
    g1 = (m3 / n) / F.pow(m2 / n, 1.5)
    g2 = (m4 / n) / F.pow(m2 / n, 2) - 3
    skew = F.when(n >= 3, F.when(m2 == 0, F.lit(0.0)).otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))
    kurt = F.when(n >= 4, F.when(m2 == 0, F.lit(0.0)).otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)))
    mn = F.least(*xs) if len(xs) > 1 else xs[0]
    mx = F.greatest(*xs) if len(xs) > 1 else xs[0]
    return {
        "row_sum": s, "row_mean": mean, "row_std": F.sqrt(var), "row_median": median,
        "row_min": mn, "row_max": mx, "row_range": mx - mn, "row_skew": skew, "row_kurt": kurt,
    }


def row_count_if(cols, predicate) -> Column:
    """Row-wise count of columns satisfying ``predicate(Column) -> Column``."""
    return reduce(lambda a, b: a + b, [flag(predicate(col(c))) for c in cols])
