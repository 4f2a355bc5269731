"""Feature packs as tables of formulas.

A pack is a mapping of output names to Spark SQL expressions in which ``{name}`` stands for another
formula of the pack or a column, and ``{@name}`` for the column even where a formula has that name (as does
a formula's own name inside itself). ``derive`` inlines the references and projects once. A formula that needs
a column which the frame lacks is left out, and so is everything built on it; ``WeightedSum`` leaves
out single terms, ``Prefer`` falls back from an existing column to a proxy and then to a constant.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import q

_REF = re.compile(r"\{(@?)(\w+)\}")
_DECIMAL = re.compile(r"(?<![\w.])(\d+\.\d+)(?![\dDeE.])")


@dataclass(frozen=True)
class WeightedSum:
    """Sum of weight times expression over the terms whose columns exist."""
    terms: tuple


@dataclass(frozen=True)
class Prefer:
    """The column of the formula's own name, read as a number, where it exists; else ``proxy``.
    ``default`` replaces a null of the column, ``proxy_default`` one of the proxy; ``kind`` casts."""
    proxy: str
    default: object = None
    proxy_default: object = None
    kind: str = "double"
    proxies: tuple = field(default_factory=tuple)  # tried after ``proxy``


class Missing(Exception):
    pass


def derive(df: DataFrame, pack: dict, keep=None) -> DataFrame:
    """``df`` with the pack's outputs, formulas last; ``keep`` names the input columns to hold (all
    if None). An output replaces an input column of its name."""
    have = set(df.columns)
    texts = {}
    for name in pack:
        try:
            texts[name] = _text(name, pack, have, ())
        except Missing:
            pass
    inputs = df.columns if keep is None else [c for c in keep if c in have]
    return df.select(*[F.col(q(c)) for c in inputs if c not in texts], *[F.expr(t).alias(n) for n, t in texts.items()])


def _text(name: str, pack: dict, have: set, path: tuple) -> str:
    """The inlined expression of a formula."""
    if name in path:
        raise ValueError(f"formula {name} refers to itself through {path}")
    path = (*path, name)

    def inline(expr: str) -> str:
        def ref(m):
            raw, other = m.groups()
            if not raw and other != name and other in pack:
                return f"({_text(other, pack, have, path)})"
            if other in have:
                return q(other)
            raise Missing(other)
        return _REF.sub(ref, _DECIMAL.sub(r"\1D", expr))

    def first(exprs):
        for e in exprs:
            try:
                return inline(e)
            except Missing:
                continue
        raise Missing(name)

    f = pack[name]
    if isinstance(f, WeightedSum):
        parts = []
        for weight, expr in f.terms:
            try:
                parts.append(f"{float(weight)}D * ({inline(expr)})")
            except Missing:
                continue
        return " + ".join(parts) or "0D"
    if isinstance(f, Prefer):
        if name in have:
            out, default = f"try_cast(cast({q(name)} as string) as double)", f.default
        else:
            out, default = first((f.proxy, *f.proxies)), f.proxy_default
        if default is not None:
            out = f"coalesce({out}, {default})"
        return f"cast({out} as {f.kind})"
    return inline(f)


# --- pieces of formulas ----------------------------------------------------------------------

def holds(cond: str) -> str:
    """1 where the condition is true, 0 where it is false or unknown."""
    return f"coalesce(cast(({cond}) as int), 0)"


def flags(classes: dict) -> dict:
    """One 0/1 formula for each class of a value."""
    return {name: holds(cond) for name, cond in classes.items()}


def last_true(rules, default=0) -> str:
    """Value of the last rule ``(condition, value)`` that holds."""
    return "case " + " ".join(f"when {c} then {v}" for c, v in reversed(list(rules))) + f" else {default} end"


def interval(value: str, edges, outside) -> str:
    """Number of the right-closed interval between ``edges``, ``outside`` elsewhere and for nulls."""
    return "case " + " ".join(f"when {value} > {a} and {value} <= {b} then {k}"
                              for k, (a, b) in enumerate(zip(edges, edges[1:]))) + f" else {outside} end"


def coded(value: str, codes: dict, other="null") -> str:
    return f"case {value} " + " ".join(f"when {k} then {v}" for k, v in codes.items()) + f" else {other} end"


def clipped(value: str, low, high) -> str:
    """Null stays null (``greatest`` and ``least`` would skip it)."""
    return f"if(({value}) is null, null, least(greatest({value}, {low}), {high}))"


def products(pairs: dict) -> dict:
    """F31 by name: output -> (a, b)."""
    return {name: f"{{{a}}} * {{{b}}}" for name, (a, b) in pairs.items()}
