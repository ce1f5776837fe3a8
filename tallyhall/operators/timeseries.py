"""Series operators: rolling stats, anomalies, densify, stock checks and
forecasts (W4-W11, T1-T9).

Every window is partitioned by the series key(s); a daily series is an
aggregate (days × series), so its size follows the calendar, not the fact
volume. Global statistics are attached with a one-row aggregate joined back
(J20) instead of an unpartitioned window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .combine import attach_global_stats, with_scalars


def _list(x):
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _w(by, order):
    by = _list(by)
    # Without ``by`` the frame is one series in one task: meant for a single
    # aggregated daily series (rows = days). Registered queries pass ``by``.
    return (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(*_list(order))


def rolling_mean(df: DataFrame, value: str, order: str, by=None, n: int = 7,
                 out: str = "rolling_mean", diff: str | None = "diff_from_rolling") -> DataFrame:
    """Mean of the last ``n`` rows, null until ``n`` rows exist; optional
    difference of the value from it."""
    w = _w(by, order).rowsBetween(-(n - 1), 0)
    m = F.when(F.count(value).over(w) == n, F.avg(value).over(w))
    r = df.withColumn(out, m)
    return r.withColumn(diff, F.col(value) - F.col(out)) if diff else r


def rolling_median(df: DataFrame, value: str, order: str, by=None, n: int = 28,
                   out: str = "rolling_median", dev: str | None = "deviation") -> DataFrame:
    """Median of the last ``n`` rows (``percentile`` accepts ordered frames,
    ``median`` does not) and the deviation from it."""
    w = _w(by, order).rowsBetween(-(n - 1), 0)
    r = df.withColumn(out, F.percentile(F.col(value), 0.5).over(w))
    return r.withColumn(dev, F.col(value) - F.col(out)) if dev else r


def zscores(df: DataFrame, value: str, by=None, out: str = "z") -> DataFrame:
    """z = (x - mean) / sample std, per series or global."""
    s = attach_global_stats(df, value, by)
    return s.withColumn(out, F.try_divide(F.col(value) - F.col("_mean"),
                                          F.nullif(F.col("_std"), F.lit(0.0)))) \
        .drop("_mean", "_std")


def iqr_fences(df: DataFrame, value: str, by=None, k: float = 1.5,
               method: str = "auto") -> DataFrame:
    """Rows outside [q1 - k·IQR, q3 + k·IQR] of their series."""
    from .describe import quantiles
    by = _list(by)
    q = quantiles(df, value, [0.25, 0.75], by, method).select(
        *by, F.col("quantiles")[0].alias("_q1"), F.col("quantiles")[1].alias("_q3"))
    # one row per series: bounded by the number of series, size-checked
    from .lookup import maybe_broadcast
    j = df.join(maybe_broadcast(q), by) if by else with_scalars(df, q)
    lo = F.col("_q1") - k * (F.col("_q3") - F.col("_q1"))
    hi = F.col("_q3") + k * (F.col("_q3") - F.col("_q1"))
    return (j.withColumn("lower_fence", lo).withColumn("upper_fence", hi)
            .filter((F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence")))
            .drop("_q1", "_q3"))


def rule_hits(df: DataFrame, keys, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Evaluate named rules ``{name: (hit, value)}`` in one pass and return
    one row per (keys, rule) that fired."""
    arr = F.array(*[F.struct(F.lit(n).alias("rule"), F.coalesce(h, F.lit(False)).alias("hit"),
                             v.cast("double").alias("value")) for n, (h, v) in rules.items()])
    return (df.select(*_list(keys), F.explode(arr).alias("r"))
            .filter("r.hit").select(*_list(keys), "r.rule", "r.value"))


def densify_ffill(df: DataFrame, by, date: str, value: str, out: str = "value_ffill") -> DataFrame:
    """One row per series per day between its first and last day, the
    value carried forward from the last observed day."""
    by = _list(by)
    bounds = df.groupBy(*by).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    spine = bounds.select(*by, F.explode(F.sequence("_lo", "_hi")).alias(date))
    j = spine.join(df, by + [date], "left")
    w = Window.partitionBy(*by).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return (j.withColumn(out, F.last(value, ignorenulls=True).over(w))
            .withColumn("is_filled", F.col(value).isNull().cast("int")))


def stock_continuity(df: DataFrame, by, date: str, opening: str, closing: str) -> DataFrame:
    """Opening stock against the prior row's closing stock."""
    w = _w(by, date)
    return (df.withColumn("prev_closing", F.lag(closing).over(w))
            .withColumn("continuity_gap", F.col(opening) - F.col("prev_closing")))


def stock_variance(df: DataFrame, opening="opening_stock", purchase="purchase_qty",
                   transfer="transfer_qty", consumption="consumption_qty", waste="waste_qty",
                   closing="closing_stock", transfer_sign: int = -1) -> DataFrame:
    """theoretical = opening + purchase ± transfer − consumption − waste;
    variance = closing − theoretical (transfer counted out by default)."""
    theo = (F.col(opening) + F.col(purchase) + transfer_sign * F.col(transfer)
            - F.col(consumption) - F.col(waste))
    return df.withColumn("theoretical_closing", theo).withColumn(
        "inventory_variance", F.col(closing) - F.col("theoretical_closing"))


def moving_unit_cost(df: DataFrame, by, order: str, total: str, qty: str,
                     out: str = "moving_unit_cost") -> DataFrame:
    """Running Σ total / Σ qty per series (all rows up to this one)."""
    w = _w(by, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.try_divide(F.sum(total).over(w).cast("double"),
                                           F.nullif(F.sum(qty).over(w).cast("double"),
                                                    F.lit(0.0))))


def last_n(df: DataFrame, by, order: str, n: int) -> DataFrame:
    """The last ``n`` rows of each series by ``order``."""
    w = _w(by, F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def wave_forecast(levels: DataFrame, by, level: str, start: str, horizon: int = 90,
                  amplitude: float = 0.05, period: float = 7.0) -> DataFrame:
    """Level × (1 + amplitude·sin(i/period)) for i = 1..horizon, dated from
    ``start`` + i − 1 (start = last observed day + 1)."""
    by = _list(by)
    return (levels.select(*by, level, start,
                          F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
            .select(*by, F.date_add(start, F.col("step") - 1).alias("forecast_date"), "step",
                    (F.col(level) * (1 + amplitude * F.sin(F.col("step") / period)))
                    .alias("forecast")))


def accuracy(actual: DataFrame, forecast: DataFrame, keys, actual_col: str = "actual",
             fc_col: str = "forecast") -> DataFrame:
    """T4: MAPE (zero actuals excluded), MAE and RMSE per key."""
    keys = _list(keys)
    err = F.col(fc_col) - F.col(actual_col)
    ape = F.when(F.col(actual_col) != 0, F.abs(err) / F.abs(F.col(actual_col)))
    return (forecast.join(actual, keys + ["forecast_date"])
            .groupBy(*keys).agg(F.count("*").alias("n"),
                                (F.avg(ape) * 100).alias("mape"),
                                F.avg(F.abs(err)).alias("mae"),
                                F.sqrt(F.avg(err * err)).alias("rmse")))


# ---------------------------------------------------------------- T3 (grouped pandas)
SEASONAL_SCHEMA = ("series string, model string, forecast_date date, step int, "
                   "forecast double, holdout_mape double, chosen int")


def _hw_fit(y, season, mode, alpha=0.3, beta=0.05, gamma=0.2):
    """Holt-Winters recurrences (additive or multiplicative seasonality)."""
    import numpy as np
    n = len(y)
    if n < 2 * season:
        lvl, trend, seas = float(np.mean(y)) if n else 0.0, 0.0, np.zeros(season) if mode == "add" \
            else np.ones(season)
        return lvl, trend, seas
    lvl = float(np.mean(y[:season]))
    trend = float((np.mean(y[season:2 * season]) - np.mean(y[:season])) / season)
    if mode == "add":
        seas = np.array(y[:season], dtype=float) - lvl
    else:
        seas = np.array(y[:season], dtype=float) / (lvl if lvl else 1.0)
    for t in range(n):
        s = seas[t % season]
        if mode == "add":
            new_l = alpha * (y[t] - s) + (1 - alpha) * (lvl + trend)
            seas[t % season] = gamma * (y[t] - new_l) + (1 - gamma) * s
        else:
            new_l = alpha * (y[t] / (s if s else 1.0)) + (1 - alpha) * (lvl + trend)
            seas[t % season] = gamma * (y[t] / (new_l if new_l else 1.0)) + (1 - gamma) * s
        trend = beta * (new_l - lvl) + (1 - beta) * trend
        lvl = new_l
    return lvl, trend, seas


def _hw_forecast(state, n_obs, h, season, mode):
    lvl, trend, seas = state
    out = []
    for i in range(1, h + 1):
        s = seas[(n_obs + i - 1) % season]
        out.append((lvl + i * trend) + s if mode == "add" else (lvl + i * trend) * s)
    return out


def seasonal_forecast_group(pdf, horizon=90, holdout=90, season=7):
    """Per-series T3 body (pandas in, pandas out): fit both seasonal modes on
    the series minus the holdout, score MAPE on the holdout, refit the chosen
    mode on the whole series and forecast ``horizon`` days."""
    import numpy as np
    import pandas as pd
    pdf = pdf.sort_values("ds")
    y = pdf["y"].astype(float).to_numpy()
    series = str(pdf["series"].iloc[0])
    last = pd.Timestamp(pdf["ds"].iloc[-1])
    train, test = (y[:-holdout], y[-holdout:]) if len(y) > holdout + 2 * season else (y, y[:0])
    scores = {}
    for mode in ("add", "mul"):
        if len(test) == 0 or (mode == "mul" and (train <= 0).any()):
            scores[mode] = math.inf if mode == "mul" and (train <= 0).any() else float("nan")
            continue
        fc = np.array(_hw_forecast(_hw_fit(train, season, mode), len(train), len(test), season, mode))
        nz = test != 0
        scores[mode] = float(np.mean(np.abs(fc[nz] - test[nz]) / np.abs(test[nz])) * 100) \
            if nz.any() else float("nan")
    finite = {m: s for m, s in scores.items() if s == s and s != math.inf}
    chosen = min(finite, key=finite.get) if finite else "add"
    rows = []
    for mode in ("add", "mul"):
        if mode == "mul" and (y <= 0).any():
            continue
        fc = _hw_forecast(_hw_fit(y, season, mode), len(y), horizon, season, mode)
        for i, v in enumerate(fc, start=1):
            rows.append((series, mode, (last + pd.Timedelta(days=i)).date(), i, float(v),
                         None if scores[mode] != scores[mode] or scores[mode] == math.inf
                         else scores[mode], int(mode == chosen)))
    return pd.DataFrame(rows, columns=["series", "model", "forecast_date", "step", "forecast",
                                       "holdout_mape", "chosen"])


def seasonal_forecast(df: DataFrame, series: str, ds: str, y: str, horizon: int = 90,
                      holdout: int = 90, season: int = 7) -> DataFrame:
    """Per-series Holt-Winters (additive vs multiplicative, picked by
    holdout MAPE) with ``groupBy(series).applyInPandas``. Each group is one
    aggregated daily series (days × 1 rows), so the pandas side stays small."""
    d = df.select(F.col(series).cast("string").alias("series"), F.col(ds).alias("ds"),
                  F.col(y).cast("double").alias("y"))

    def fn(pdf):
        return seasonal_forecast_group(pdf, horizon, holdout, season)

    return d.groupBy("series").applyInPandas(fn, SEASONAL_SCHEMA)
