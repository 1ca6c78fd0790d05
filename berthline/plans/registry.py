"""Query registry: name -> Spark builder, and name -> DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def half_up_sql(sql: str, digits: int = 4) -> str:
    """Rewrite every ``round(expr, digits)`` into ``floor(expr * 10^d + 0.5) / 10^d``.

    Matches :func:`berthline.plans.tables.round_half_up` bit for bit.
    """
    out, i, low = [], 0, sql.lower()
    scale = 10 ** digits
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, -1
        while k < len(sql):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        inner = sql[j + 6:comma] if comma >= 0 else None
        if inner is None or sql[comma + 1:k].strip() != str(digits):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        out.append(sql[i:j])
        out.append(f"(floor(({half_up_sql(inner, digits)}) * {scale} + 0.5) / {scale})")
        i = k + 1


def register(name: str, sql: str | None = None):
    """Register a query builder and (when SQL can express it) its DuckDB twin."""
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = half_up_sql(sql)
        return fn
    return deco
