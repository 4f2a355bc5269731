"""Small helpers that write DuckDB oracle text (long form, per-feature unions)."""

from __future__ import annotations


def qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def long_sql(src: str, cols, keep=()) -> str:
    """Unpivot ``cols`` of ``src`` (a CTE name) to (keep..., feature, value DOUBLE), nulls dropped."""
    parts = []
    for c in cols:
        k = "".join(f"{qi(x)}, " for x in keep)
        parts.append(f"SELECT {k}'{c}' AS feature, CAST({qi(c)} AS DOUBLE) AS value FROM {src} WHERE {qi(c)} IS NOT NULL")
    return "\nUNION ALL ".join(parts)


def per_feature(src: str, cols, select_tpl: str, group: str = "") -> str:
    """UNION ALL of ``select_tpl`` formatted with {c} (quoted column) and {name} per column."""
    parts = []
    for c in cols:
        text = select_tpl.format(c=qi(c), name=c)
        parts.append(f"SELECT '{c}' AS feature, {text} FROM {src}" + (f" GROUP BY {group}" if group else ""))
    return "\nUNION ALL ".join(parts)
