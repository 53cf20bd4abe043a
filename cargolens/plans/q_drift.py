"""Drift profile and warnings of both problems (SCO-6, SCO-7): inputs on the scale the linear models see them, the band
turned back to units, the share of training rows outside it, and a sentence for each drifted input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import r
from ..operators.ranking import attach
from ..registry import query
from ..sources.fixtures import market
from .q_eval import item_split, split

# Scale of each numeric input and the categorical inputs, by problem.
SCALES = {
    "freight": {"weight_kg": "log1p", "volume_cm3": "log1p", "chargeable_kg": "log1p", "distance_km": "log1p", "price": "log1p",
                "n_items": "count", "n_sellers": "count"},
    "late": {"promised_days": "raw", "distance_km": "log1p", "price_total": "log1p", "freight_total": "log1p",
             "freight_ratio": "raw", "n_items": "count", "n_sellers": "count"},
}
LEVELS = {"freight": ["category", "seller_state", "customer_state"], "late": ["seller_state", "customer_state"]}
KEYS = {"freight": ["order_id", "order_item_id"], "late": ["order_id"]}
Z = 3.0
# The sentences.
TOO_MANY = "{c} = {x} is above the largest value seen in training ({max})"
FAR = "{c} = {x} is {side} the training mean {sign} 3 sd{scale} ({bound}): the model has seen few cases like this"
UNSEEN = "{c} '{x}' was not seen in training: the model treats it as a rare value"
NO_LEVEL = "None"


def _scaled(c: str, scale: str) -> Column:
    x = F.col(c).cast("double")
    # greatest() passes over nulls: a missing value must stay missing
    return F.when(x.isNotNull(), F.log1p(F.greatest(x, F.lit(0.0)))) if scale == "log1p" else x


def drift_profile(train: DataFrame, scales: dict[str, str]) -> DataFrame:
    """SCO-6: one row an input: scale, mean, sd, rows, the band of ``Z`` sd in units, the share of training rows outside
    it, and the largest count.  Two aggregations of the training rows."""
    moments = train.agg(*[f(_scaled(c, s)).alias(f"{c}__{n}") for c, s in scales.items()
                          for n, f in (("mean", F.avg), ("std", F.stddev_samp), ("n", F.count), ("max", F.max))])
    def outside(c, s):
        far = F.abs(_scaled(c, s) - F.col(f"{c}__mean")) > Z * F.col(f"{c}__std")
        return F.avg(far.cast("double")).alias(f"{c}__outside")
    shares = attach(train, moments).agg(*[outside(c, s) for c, s in scales.items()])
    none = F.lit(None).cast("double")

    def row(c, s):
        mean, std = F.col(f"{c}__mean"), F.col(f"{c}__std")
        def bound(v):
            return F.expm1(v) if s == "log1p" else v
        if s == "count":
            numbers = [none, none, none, none, none, F.col(f"{c}__max")]
        else:
            numbers = [mean, std, bound(mean - Z * std), bound(mean + Z * std), F.round(F.col(f"{c}__outside"), 4), none]
        return F.struct(F.lit(c).alias("column"), F.lit(s).alias("scale"), F.col(f"{c}__n").alias("n"),
                        *[v.alias(k) for k, v in zip(("mean", "std", "low", "high", "train_share_outside", "max"), numbers)])
    both = attach(moments, shares)
    return both.select(F.explode(F.array(*[row(c, s) for c, s in scales.items()])).alias("e")).select("e.*")


def _sentence(template: str, **parts) -> Column:
    """The template with columns in the place of names."""
    out, rest = [], template
    while "{" in rest:
        text, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        out += [F.lit(text), parts[name] if isinstance(parts[name], Column) else F.lit(parts[name])]
    return F.concat(*out, F.lit(rest))


def drift_warnings(rows: DataFrame, train: DataFrame, scales: dict[str, str], levels: list[str]) -> DataFrame:
    """SCO-7: ``rows`` with ``drift_inputs`` and ``warnings``, in the order of the inputs: numeric ones more than ``Z`` sd
    from the training mean on their scale, counts above the training maximum, levels that training didn't have (null is a
    level).  A numeric input without a value is never flagged."""
    wide = drift_profile(train, scales).groupBy().pivot("column", list(scales)).agg(F.first(F.struct("mean", "std", "low", "high", "max")))
    x = attach(rows, wide.select(*[F.col(c).alias(f"_st_{c}") for c in scales]))
    found = []
    for c, s in scales.items():
        v, st = _scaled(c, s), f"_st_{c}"
        if s == "count":
            text = _sentence(TOO_MANY, c=c, x=F.col(c).cast("long").cast("string"), max=F.col(f"{st}.max").cast("long").cast("string"))
            hit = v > F.col(f"{st}.max")
        else:
            above = v > F.col(f"{st}.mean")
            text = _sentence(FAR, c=c, x=F.format_number(F.col(c).cast("double"), 2), side=F.when(above, "above").otherwise("below"),
                             sign=F.when(above, "+").otherwise("-"), scale=" on the log scale" if s == "log1p" else "",
                             bound=F.format_number(F.when(above, F.col(f"{st}.high")).otherwise(F.col(f"{st}.low")), 2))
            hit = F.abs(v - F.col(f"{st}.mean")) > Z * F.col(f"{st}.std")
        found.append(F.when(hit, F.struct(F.lit(c).alias("c"), text.alias("t"))))
    for c in levels:
        def level(of: DataFrame) -> Column:
            return F.coalesce(of[c].cast("string"), F.lit(NO_LEVEL))
        seen = train.select(level(train).alias(f"_lv_{c}")).distinct().withColumn(f"_seen_{c}", F.lit(True))
        x = x.join(seen, level(x) == F.col(f"_lv_{c}"), "left")
        text = _sentence(UNSEEN, c=c, x=F.coalesce(F.col(c).cast("string"), F.lit(NO_LEVEL)))
        found.append(F.when(F.col(f"_seen_{c}").isNull(), F.struct(F.lit(c).alias("c"), text.alias("t"))))
    x = x.withColumn("_found", F.array_compact(F.array(*found)))
    return x.select(*[F.col(c) for c in rows.columns], F.col("_found.c").alias("drift_inputs"), F.col("_found.t").alias("warnings"))


def _sql_scaled(c: str, s: str, of: str = "") -> str:
    return f"CASE WHEN {of}{c} IS NOT NULL THEN ln(1 + greatest({of}{c}, 0.0)) END" if s == "log1p" else f"CAST({of}{c} AS DOUBLE)"


def _sql_profile(problem: str, table: str) -> str:
    parts = []
    for c, s in SCALES[problem].items():
        v = _sql_scaled(c, s)
        if s == "count":
            parts.append(f"SELECT '{problem}' AS problem, '{c}' AS \"column\", 'count' AS scale, count({c}) AS n, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, "
                         f"NULL::DOUBLE AS low, NULL::DOUBLE AS high, NULL::DOUBLE AS train_share_outside, max({c})::DOUBLE AS max FROM {table}")
            continue
        low, high = (f"exp(mu {sign} 3 * sd) - 1" if s == "log1p" else f"mu {sign} 3 * sd" for sign in "-+")
        parts.append(f"SELECT '{problem}', '{c}', '{s}', n, mu, sd, {low}, {high}, "
                     f"(SELECT round(avg(CASE WHEN abs({v} - mu) > 3 * sd THEN 1.0 WHEN {c} IS NOT NULL THEN 0.0 END), 4) FROM {table}), NULL::DOUBLE "
                     f"FROM (SELECT count({c}) AS n, avg({v}) AS mu, stddev_samp({v}) AS sd FROM {table})")
    parts.sort(key=lambda p: "AS problem" not in p)       # the branch that names the columns first
    return "\nUNION ALL ".join(parts)


def _frames(m, problem: str):
    return item_split(m) if problem == "freight" else split(m)


@query("sco06_drift_profile", f"""
SELECT problem, "column", scale, n, round_even(mean, 6) AS mean, round_even(std, 6) AS std, round_even(low, 6) AS low,
       round_even(high, 6) AS high, train_share_outside, max
FROM ({_sql_profile("freight", "f_itrain")} UNION ALL {_sql_profile("late", "f_train")})
""")
def sco06_drift_profile(spark, sf):
    """SCO-6: drift statistics of the inputs of both problems, fitted on their training windows."""
    m = market(spark, sf)
    out = None
    for problem, scales in SCALES.items():
        train, _ = _frames(m, problem)
        p = drift_profile(train, scales).withColumn("problem", F.lit(problem))
        out = p if out is None else out.unionByName(p)
    return out.select("problem", "column", "scale", "n", *[r(c, 6).alias(c) for c in ("mean", "std", "low", "high")],
                      "train_share_outside", "max")


def _sql_warnings(problem: str, train: str, test: str) -> str:
    items = []
    for c, s in SCALES[problem].items():
        v, st = _sql_scaled(c, s, "t."), f"(SELECT {{}} FROM st WHERE problem = '{problem}' AND \"column\" = '{c}')"
        if s == "count":
            items.append(f"CASE WHEN t.{c} > {st.format('max')} THEN ['{c}', '{c} = ' || CAST(t.{c} AS BIGINT) || "
                         f"' is above the largest value seen in training (' || CAST({st.format('max')} AS BIGINT) || ')'] END")
            continue
        log = " on the log scale" if s == "log1p" else ""
        number = "format('{{:,.2f}}', {})"
        for side, sign, bound, cmp in (("above", "+", "high", ">"), ("below", "-", "low", "<")):
            items.append(f"CASE WHEN {v} {cmp} {st.format('mean')} AND abs({v} - {st.format('mean')}) > 3 * {st.format('std')} THEN ['{c}', '{c} = ' || "
                         f"{number.format(f't.{c}::DOUBLE')} || ' is {side} the training mean {sign} 3 sd{log} (' || "
                         f"{number.format(st.format(bound))} || '): the model has seen few cases like this'] END")
    for c in LEVELS[problem]:
        lv = f"coalesce(CAST(t.{c} AS VARCHAR), '{NO_LEVEL}')"
        items.append(f"CASE WHEN {lv} NOT IN (SELECT coalesce(CAST({c} AS VARCHAR), '{NO_LEVEL}') FROM {train}) THEN ['{c}', '{c} ''' || {lv} || "
                     "''' was not seen in training: the model treats it as a rare value'] END")
    item = "CAST(NULL AS BIGINT)" if problem == "late" else "t.order_item_id"
    return (f"SELECT '{problem}' AS problem, t.order_id, {item} AS order_item_id, "
            f"list_filter([{', '.join(items)}], lambda e: e IS NOT NULL) AS w FROM {test} t")


@query("sco07_drift_warnings", f"""
WITH st AS ({_sql_profile("freight", "f_itrain")} UNION ALL {_sql_profile("late", "f_train")}),
x AS ({_sql_warnings("freight", "f_itrain", "f_itest")} UNION ALL {_sql_warnings("late", "f_train", "f_test")})
SELECT problem, order_id, CAST(order_item_id AS BIGINT) AS order_item_id, array_to_string(list_transform(w, lambda e: e[1]), ',') AS drift_inputs,
       array_to_string(list_transform(w, lambda e: e[2]), ' | ') AS warnings
FROM x WHERE len(w) > 0
""")
def sco07_drift_warnings(spark, sf):
    """SCO-7: the hold-out rows of both problems that have drifted inputs, with the inputs and the sentences."""
    m = market(spark, sf)
    out = None
    for problem, scales in SCALES.items():
        train, test = _frames(m, problem)
        w = drift_warnings(test, train, scales, LEVELS[problem]).filter(F.size("drift_inputs") > 0)
        item = F.col("order_item_id") if "order_item_id" in KEYS[problem] else F.lit(None)
        w = w.select(F.lit(problem).alias("problem"), "order_id", item.cast("long").alias("order_item_id"),
                     F.concat_ws(",", "drift_inputs").alias("drift_inputs"), F.concat_ws(" | ", "warnings").alias("warnings"))
        out = w if out is None else out.unionByName(w)
    return out
