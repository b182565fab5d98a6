"""Monthly order volume per series, scored against naive baselines on the last complete months.

A series is any slice of the orders (all, per state, per category); Spark handles series in parallel.  A series
has one row per calendar month, so windows and groups over it are as long as the calendar and no longer.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..operators.ordered import shuffle_width

HORIZON = 3
MIN_SHARE_OF_MEDIAN = 0.10
MIN_TRAIN_MONTHS = 12
SEASON = 12

# Candidate, kind; the order breaks ties between equal scores.
MODELS = (
    ("naive_last_value", "baseline"),
    ("seasonal_naive_12m", "baseline"),
    ("moving_average_3m", "model"),
    ("holt_damped_trend", "model"),
)
ALL = tuple(m for m, _ in MODELS)
SIMPLE = ("naive_last_value", "seasonal_naive_12m", "moving_average_3m")


def monthly_orders(orders: DataFrame, dates: DataFrame, series: Column | None = None) -> DataFrame:
    """Orders per series and month, without holes: a month without orders counts zero."""
    name = series if series is not None else F.lit("all")
    month = dates.select(F.col("date_key").alias("purchase_date_key"), "month_start")
    counted = (
        orders.groupBy(name.alias("series"), "purchase_date_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(month, "purchase_date_key")
        .groupBy("series", "month_start")
        .agg(F.sum("n").alias("orders"))
    )
    spine = (
        counted.groupBy("series")
        .agg(F.min("month_start").alias("a"), F.max("month_start").alias("b"))
        .select("series", F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month_start"))
    )
    return spine.join(counted, ["series", "month_start"], "left").select(
        "series", "month_start", F.coalesce("orders", F.lit(0)).alias("orders")
    )


def complete_window(months: DataFrame) -> DataFrame:
    """Mark the longest run of complete months (at least 10 % of the median); the first run wins a tie.

    Adds ``used``, and for used months ``idx`` (1..n) and ``n``.
    """
    whole = Window.partitionBy("series")
    along = whole.orderBy("month_start")
    median = F.median("orders").over(whole)
    marked = (
        months.withColumn("_ok", F.col("orders") >= F.lit(MIN_SHARE_OF_MEDIAN) * median)
        .withColumn("_run", F.sum(F.when(F.col("_ok"), 0).otherwise(1)).over(along))
        .withColumn("_len", F.sum(F.when(F.col("_ok"), 1).otherwise(0)).over(Window.partitionBy("series", "_run")))
    )
    best = marked.withColumn("_longest", F.max("_len").over(whole)).withColumn(
        "_best", F.min(F.when((F.col("_len") == F.col("_longest")) & F.col("_ok"), F.col("_run"))).over(whole)
    )
    used = F.coalesce(F.col("_ok") & (F.col("_run") == F.col("_best")), F.lit(False))
    return (
        best.withColumn("used", used)
        .withColumn("idx", F.when(F.col("used"), F.sum(F.when(F.col("used"), 1).otherwise(0)).over(along)))
        .withColumn("n", F.when(F.col("used"), F.col("_longest")))
        .select("series", "month_start", "orders", "used", "idx", "n")
    )


def usable(window: DataFrame) -> DataFrame:
    """Used months of the series that can be scored: long enough, and no zero in the holdout."""
    zero = F.bool_or((F.col("idx") > F.col("n") - HORIZON) & (F.col("orders") == 0)).over(Window.partitionBy("series"))
    return (
        window.where("used")
        .withColumn("_zero", zero)
        .where((F.col("n") >= MIN_TRAIN_MONTHS + HORIZON) & ~F.col("_zero"))
        .drop("_zero")
    )


def simple_forecasts(used: DataFrame, holdout: int) -> DataFrame:
    """Last value, same month a year ago and mean of three months, made ``holdout`` months before the end."""
    last = F.col("n") - holdout
    at = F.col("idx")

    def value(offset: int) -> Column:
        return F.max(F.when(at == last + offset, F.col("orders"))).cast("double")

    recent = F.avg(F.when((at > last - 3) & (at <= last), F.col("orders")))
    stats = used.groupBy("series").agg(
        F.max(last).alias("_origin"),
        value(0).alias("_last"),
        recent.alias("_mean3"),
        *[value(h - SEASON).alias(f"_season{h}") for h in range(1, HORIZON + 1)],
    )
    enough = F.col("_origin") >= SEASON
    rows = []
    for h in range(1, HORIZON + 1):
        by_model = {
            "naive_last_value": F.col("_last"),
            "seasonal_naive_12m": F.when(enough, F.col(f"_season{h}")),
            "moving_average_3m": F.col("_mean3"),
        }
        for model, kind in MODELS:
            if model in by_model:
                rows.append(F.struct(F.lit(model).alias("model"), F.lit(kind).alias("kind"), F.lit(h).alias("h"),
                                     by_model[model].alias("predicted")))
    return stats.select("series", F.inline(F.array(*rows)))


# Damped trend: smoothing parameters tried first, and steps around the best of them tried then.
ALPHAS, BETAS, PHIS = (0.05, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95), (0.0, 0.05, 0.1, 0.2, 0.4, 0.8), (0.8, 0.85, 0.9, 0.95, 0.98)
STEPS = ((-0.1, -0.05, 0.0, 0.05, 0.1), (-0.05, -0.025, 0.0, 0.025, 0.05), (-0.02, 0.0, 0.02))
LIMITS = ((0.01, 0.99), (0.0, 1.0), (0.8, 0.995))
RIDGE = 1e-9
SSE_DIGITS = 3
FORECAST_DIGITS = 6
_PARAMS = ("alpha", "beta", "phi")
_STATE = ("lc", "la", "lb", "tc", "ta", "tb")  # level and trend: constant, share of the start level, share of the start trend
_SUMS = ("aa", "ab", "bb", "ay", "by", "yy")  # of the one-step errors' normal equations


def _fold(y: Column, alpha: Column, beta: Column, phi: Column) -> Column:
    """State and sums after all months; everything is linear in the two unknown start values."""

    def step(s: Column, v: Column) -> Column:
        seen = {k: s[f"l{k}"] + phi * s[f"t{k}"] for k in "cab"}
        level = {k: (1 - alpha) * seen[k] for k in "ab"} | {"c": alpha * v + (1 - alpha) * seen["c"]}
        trend = {k: beta * (level[k] - s[f"l{k}"]) + (1 - beta) * phi * s[f"t{k}"] for k in "cab"}
        rest = v - seen["c"]
        sums = {"aa": seen["a"] * seen["a"], "ab": seen["a"] * seen["b"], "bb": seen["b"] * seen["b"], "ay": seen["a"] * rest, "by": seen["b"] * rest, "yy": rest * rest}
        new = [({"l": level, "t": trend}[c[0]][c[1]]).alias(c) for c in _STATE]
        return F.struct(*new, *[(s[c] + sums[c]).alias(c) for c in _SUMS])

    start = F.struct(*[F.lit(1.0 if c in ("la", "tb") else 0.0).alias(c) for c in (*_STATE, *_SUMS)])
    return F.aggregate(y, start, step)


def _solved(s: Column) -> tuple[Column, Column, Column]:
    """Start level, start trend and squared error of the best start values."""
    aa, bb, ab = s["aa"] + F.lit(RIDGE), s["bb"] + F.lit(RIDGE), s["ab"]
    det = aa * bb - ab * ab
    level, trend = (s["ay"] * bb - ab * s["by"]) / det, (aa * s["by"] - ab * s["ay"]) / det
    return level, trend, s["yy"] - level * s["ay"] - trend * s["by"]


def _best(tried: DataFrame) -> DataFrame:
    """The parameters with the smallest squared error of each series; ties go by the order of the parameters."""
    fitted = tried.withColumn("s", _fold(F.col("y"), *map(F.col, _PARAMS)))
    level, trend, sse = _solved(F.col("s"))
    fitted = fitted.withColumn("level0", level).withColumn("trend0", trend).withColumn("sse", half_up(sse, SSE_DIGITS))
    row = F.struct(*_PARAMS, "s", "level0", "trend0", "sse")
    return fitted.groupBy("series").agg(F.min_by(row, F.struct("sse", *_PARAMS)).alias("fit"), F.first("y").alias("y"))


def fitted_trends(train: DataFrame) -> DataFrame:
    """series, y, fit: the damped trend with the least squared one-step error over two grids of parameters.

    For fixed parameters the errors are linear in the start values, so these are solved exactly.  ``train``: series, idx, orders.
    Each triple of parameters is a row, so the fits of one series are spread as well.
    """
    months = F.transform(F.array_sort(F.collect_list(F.struct("idx", "orders"))), lambda m: m["orders"].cast("double"))
    per_series = train.groupBy("series").agg(months.alias("y"))  # a few hundred months at most
    first = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(t, _PARAMS)]) for t in itertools.product(ALPHAS, BETAS, PHIS)])
    # few bytes but much arithmetic: an explicit width keeps the fits spread over all cores
    width = shuffle_width(train)
    coarse = _best(per_series.repartition(width, "series").select("series", "y", F.inline(first)))
    near = [F.array(*[F.greatest(F.least(F.col(f"fit.{n}") + F.lit(d), F.lit(hi)), F.lit(lo)) for d in steps]) for n, steps, (lo, hi) in zip(_PARAMS, STEPS, LIMITS)]
    fine = coarse.repartition(width, "series").select("series", "y", *[a.alias(f"{n}s") for a, n in zip(near, _PARAMS)])
    for n in _PARAMS:
        fine = fine.withColumn(n, F.explode(F.array_distinct(f"{n}s")))
    return _best(fine.select("series", "y", *_PARAMS))


def holt_forecasts(used: DataFrame, holdout: int) -> DataFrame:
    """Damped trend per series, made ``holdout`` months before the end."""
    fit = fitted_trends(used.where(F.col("idx") <= F.col("n") - holdout).select("series", "idx", "orders"))
    f = F.col("fit")
    end = {k: f["s"][f"{k}c"] + f["s"][f"{k}a"] * f["level0"] + f["s"][f"{k}b"] * f["trend0"] for k in "lt"}
    rows, power, sum_ = [], None, None
    for h in range(1, HORIZON + 1):
        power = f["phi"] if power is None else power * f["phi"]
        sum_ = power if sum_ is None else sum_ + power
        ahead = half_up(end["l"] + end["t"] * sum_, FORECAST_DIGITS)
        rows.append(F.struct(F.lit("holt_damped_trend").alias("model"), F.lit("model").alias("kind"), F.lit(h).alias("h"), ahead.alias("predicted")))
    return fit.select("series", F.inline(F.array(*rows)))


def forecasts(used: DataFrame, holdout: int, models: Sequence[str]) -> DataFrame:
    out = simple_forecasts(used, holdout).where(F.col("model").isin(*[m for m in models if m in SIMPLE]))
    return out.unionByName(holt_forecasts(used, holdout)) if "holt_damped_trend" in models else out


def holdout_rows(used: DataFrame, models: Sequence[str] = SIMPLE) -> DataFrame:
    """Prediction beside the actual value for each held-out month."""
    actual = used.where(F.col("idx") > F.col("n") - HORIZON).select(
        "series", "month_start", (F.col("idx") - F.col("n") + HORIZON).cast("int").alias("h"), F.col("orders").alias("actual")
    )
    return forecasts(used, HORIZON, models).join(actual, ["series", "h"])


def scores(holdout: DataFrame) -> DataFrame:
    """Selection error: MAPE over the held-out months, NULL when a prediction is missing."""
    miss = F.abs((F.col("actual") - F.col("predicted")) / F.col("actual"))
    t = holdout.groupBy("series", "model", "kind").agg(F.avg(miss).alias("_mean"), F.count("predicted").alias("_k"))
    return t.select(
        "series", "model", "kind",
        F.when(F.col("_k") == HORIZON, half_up(F.col("_mean") * 100.0, 2)).alias("holdout_mape_pct"),
    )


def _model_order() -> Column:
    order = F.lit(len(MODELS))
    for i, (m, _) in enumerate(MODELS):
        order = F.when(F.col("model") == m, i).otherwise(order)
    return order


def choose(scored: DataFrame) -> DataFrame:
    """Winner, best baseline and best model of each series."""
    rank = F.struct("holdout_mape_pct", _model_order())
    valid = scored.where(F.col("holdout_mape_pct").isNotNull())

    def best(what: str, kind: str | None) -> Column:
        return F.min_by(F.col(what), rank if kind is None else F.when(F.col("kind") == kind, rank))

    t = valid.groupBy("series").agg(
        best("model", None).alias("winner"),
        best("kind", None).alias("winner_kind"),
        best("holdout_mape_pct", None).alias("winner_mape_pct"),
        best("model", "baseline").alias("best_baseline"),
        best("holdout_mape_pct", "baseline").alias("best_baseline_mape_pct"),
        best("model", "model").alias("best_model"),
        best("holdout_mape_pct", "model").alias("best_model_mape_pct"),
    )
    return t.withColumn("baseline_wins", F.col("winner_kind") == "baseline").withColumn(
        "model_minus_baseline_mape_pp", half_up(F.col("best_model_mape_pct") - F.col("best_baseline_mape_pct"), 2)
    )


def _months(which: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_list(F.when(which, F.date_format("month_start", "yyyy-MM")))), ",")


def run_forecast(window: DataFrame, models: Sequence[str] = SIMPLE, held: DataFrame | None = None) -> DataFrame:
    """One row per series: the window, why it was skipped if it was, and the selection result.

    ``held``: the holdout rows if they are there already.
    """
    used = F.col("used")
    size = F.count_if(used)
    spans = window.groupBy("series").agg(
        size.alias("complete_months"),
        F.min(F.when(used, F.col("month_start"))).alias("window_start"),
        F.max(F.when(used, F.col("month_start"))).alias("window_end"),
        _months(used & (F.col("idx") > F.col("n") - HORIZON)).alias("holdout_months"),
        _months(~used).alias("excluded_months"),
    )
    chosen = choose(scores(holdout_rows(usable(window), models) if held is None else held))
    out = spans.join(chosen, "series", "left").withColumn("skipped", F.col("winner").isNull())
    reason = F.concat(F.lit("only "), F.col("complete_months").cast("string"), F.lit(" complete months"))
    return (
        out.withColumn("train_months", F.when(~F.col("skipped"), F.col("complete_months") - HORIZON))
        .withColumn("holdout_months", F.when(~F.col("skipped"), F.col("holdout_months")))
        .withColumn("reason", F.when(F.col("skipped"), reason))
    )


def future(window: DataFrame, models: Sequence[str] = SIMPLE, held: DataFrame | None = None) -> DataFrame:
    """The winner refitted on all complete months: the next three months of each series."""
    used = usable(window)
    winner = choose(scores(holdout_rows(used, models) if held is None else held)).select("series", F.col("winner").alias("model"))
    own = used.join(winner, "series")
    made = simple_forecasts(own, 0)
    if "holt_damped_trend" in models:
        made = made.unionByName(holt_forecasts(own.where("model = 'holt_damped_trend'"), 0))
    end = used.groupBy("series").agg(F.max("month_start").alias("_end"))
    return (
        made.join(winner, ["series", "model"])
        .join(end, "series")
        .select("series", F.add_months("_end", F.col("h")).alias("month_start"), "model",
                half_up(F.col("predicted"), 0).cast("long").alias("orders"))
    )


def forecast_table(window: DataFrame, models: Sequence[str] = SIMPLE, held: DataFrame | None = None) -> DataFrame:
    """Actual months, held-out predictions and the forecast in one long table."""
    used = usable(window)
    held = holdout_rows(used, models) if held is None else held
    scored = used.select("series").distinct().withColumn("_scored", F.lit(True))
    actual = window.join(scored, "series", "left").select(
        "series", "month_start", F.lit("actual").alias("model"), F.lit("actual").alias("row_type"), "orders",
        (F.col("used") & F.coalesce("_scored", F.lit(False))).alias("used_in_model"),
    )
    tried = held.select(
        "series", "month_start", "model", F.lit("holdout").alias("row_type"),
        half_up(F.col("predicted"), 0).cast("long").alias("orders"), F.lit(True).alias("used_in_model"),
    )
    ahead = future(window, models, held).select(
        "series", "month_start", "model", F.lit("forecast").alias("row_type"), "orders", F.lit(False).alias("used_in_model")
    )
    return actual.unionByName(tried).unionByName(ahead).withColumn("month", F.date_format("month_start", "yyyy-MM"))
