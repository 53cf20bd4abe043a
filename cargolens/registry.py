"""Named queries: a Spark plan per inventory row and, where the result is
expressible in SQL, the DuckDB text that checks it.

A query function takes ``(spark, sf_dir)`` and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle.fixtures import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def _split_call(text: str, start: int) -> tuple[list[str], int]:
    """Arguments of the call whose '(' is at ``start``; returns (args, index after ')')."""
    depth, args, cur, i = 0, [], [], start
    quote = None
    while i < len(text):
        ch = text[i]
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
        elif ch in "'\"":
            quote = ch
            cur.append(ch)
        elif ch == "(":
            depth += 1
            if depth > 1:
                cur.append(ch)
        elif ch == ")":
            depth -= 1
            if depth == 0:
                args.append("".join(cur))
                return args, i + 1
            cur.append(ch)
        elif ch == "," and depth == 1:
            args.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
        i += 1
    raise ValueError("unbalanced parentheses in oracle SQL")


def numpy_round_sql(sql: str) -> str:
    """Expand ``round_even(x, d)`` in oracle text to the NumPy-style rounding of
    :func:`cargolens.functions.columns.r` (scale, round half to even, unscale)."""
    key = "round_even("
    out, pos = [], 0
    while True:
        i = sql.find(key, pos)
        if i < 0:
            out.append(sql[pos:])
            return "".join(out)
        args, end = _split_call(sql, i + len(key) - 1)
        x, d = numpy_round_sql(args[0]), int(args[1])
        y = f"(CAST({x} AS DOUBLE) * {float(10 ** d)})"
        out.append(sql[pos:i])
        out.append(f"((CASE WHEN {y} - floor({y}) > 0.5 THEN floor({y}) + 1 "
                   f"WHEN {y} - floor({y}) < 0.5 THEN floor({y}) "
                   f"ELSE floor({y}) + ((floor({y}) % 2) + 2) % 2 END) / {float(10 ** d)})")
        pos = end


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is the oracle (fixture CTEs are
    added automatically)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = numpy_round_sql(with_views(sql))
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from .plans import catalog  # noqa: F401
