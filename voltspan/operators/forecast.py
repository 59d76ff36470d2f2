"""Forecast models that need a recursion over the days of a series, in columns.

A series is packed into an array with one value per calendar day, so its length is bounded by the
calendar, and all work on it stays in its row: nothing is shuffled after the packing. The recursion of
exponential smoothing is a fold over the array that notes its state on the last day of every origin, so
all origins of a series share one pass.

``AutoETS`` searches additive and multiplicative errors, no, linear or damped trend, and no, additive or
multiplicative weekly season. The search halves: a coarse grid runs over the first twelfth of the days
before the earliest origin, the best few and their neighbours over the first fifth, and the best few of
these over all days; corrected AIC chooses, at the end for each origin. With ``whole`` nothing is
dropped on the way: every point of ``whole_grid`` runs over all days, and corrected AIC chooses among all
of them for each origin. Additive errors with a multiplicative season are left out, as is usual. ``MSTL`` takes weekly and yearly seasons out by local
regression (``operators.decompose``) and smooths the rest without a season.

Deviations from optimiser-based libraries: parameters come from the search above and initial states
from the first four weeks, so accuracy figures are this module's own. Bands carry the root mean square of
the in-sample errors forward, for all forms.

Defined results: an origin with fewer days than ``MIN_DAYS`` of a model gets no row from it, and neither
does a series with a null value. Candidates that reach a forecast of zero or less have no multiplicative
form.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltspan.operators import series as S
from voltspan.operators.decompose import seasons_out

# ---------------------------------------------------------------- fixed values
MODELS = ["SeasonalNaive", "AutoETS", "MSTL"]
SEASONS = (7, 365)
# the coarse grid: alpha; beta as a share of alpha with the damping; gamma as a share of 1 - alpha
ALPHAS = (0.05, 0.2, 0.5, 0.8)
TRENDS = ((0.0, 0.0), (0.1, 1.0), (0.1, 0.9))  # phi 0 means no trend, 1 undamped
SEASON_SHARES = (0.05, 0.2)
# neighbours: factors of alpha, of the shares, and another damping
STEPS = {"alpha": (0.6, 1.6), "trend": (0.3, 3.0), "season": (0.4, 2.5)}
SOFTER = 0.97
CEILING = 0.98
RUNGS = {12: 3, 5: 2}  # part of the history that a round sees, and how many it keeps
RUNG_DAYS = 210  # days that a round sees at least
# the grid of the whole search, next to all points that the halving one can reach
WHOLE_ALPHAS = (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)
WHOLE_SHARES = (0.05, 0.1, 0.3)  # beta as a share of alpha, gamma as a share of 1 - alpha
WHOLE_DAMPING = (1.0, 0.9, 0.98)
INIT_CYCLES = 4
# every place of the longest season needs two days
MIN_DAYS = {"AutoETS": INIT_CYCLES * S.SEASON, "MSTL": 2 * max(SEASONS)}
# ------------------------------------------------------------------------------
_NAMES = ("alpha", "trend", "season", "phi", "times")
_POINT = "struct<alpha:double,trend:double,season:double,phi:double,times:boolean>"


@lru_cache(maxsize=4)
def coarse_grid(seasonal: bool) -> tuple[tuple[float, float, float, float, bool], ...]:
    """Rows (alpha, trend, season, phi, times): shares, damping, and whether the season multiplies."""
    forms = [(0.0, False)] + ([(s, times) for s in SEASON_SHARES for times in (False, True)] if seasonal else [])
    return tuple((a, trend, season, phi, times) for a in ALPHAS for trend, phi in TRENDS for season, times in forms)


@lru_cache(maxsize=4)
def whole_grid(seasonal: bool) -> tuple[tuple[float, float, float, float, bool], ...]:
    """Rows as ``coarse_grid``: all combinations of the finer values, the coarse grid and each of its neighbours."""
    forms = [(0.0, False)] + ([(s, times) for s in WHOLE_SHARES for times in (False, True)] if seasonal else [])
    trends = [(0.0, 0.0)] + [(share, phi) for share in WHOLE_SHARES for phi in WHOLE_DAMPING]
    rows = [(a, trend, season, phi, times) for a in WHOLE_ALPHAS for trend, phi in trends for season, times in forms]
    for a, trend, season, phi, times in coarse_grid(seasonal):
        rows.append((a, trend, season, phi, times))
        rows.extend((min(a * f, CEILING), trend, season, phi, times) for f in STEPS["alpha"])
        if phi > 0:
            rows.extend((a, min(trend * f, CEILING), season, phi, times) for f in STEPS["trend"])
            rows.append((a, trend, season, SOFTER, times))
        if season > 0:
            rows.extend((a, trend, min(season * f, CEILING), phi, times) for f in STEPS["season"])
    # 0.1 * 3 is the point 0.3
    return tuple(sorted({(round(a, 9), round(t, 9), round(s, 9), phi, times) for a, t, s, phi, times in rows}))


def _neighbours(p: str) -> str:
    """A point of the search and those a step away along each of its own parameters."""

    def point(name: str, value: str) -> str:
        return "struct(" + ", ".join(f"{value if c == name else f"{p}.{c}"} as {c}" for c in _NAMES) + ")"

    def steps(name: str, field: str) -> list[str]:
        return [point(field, f"least({p}.{field} * {f!r}D, {CEILING!r}D)") for f in STEPS[name]]

    def points(rows: list[str]) -> str:
        return f"cast(array({', '.join(rows)}) as array<{_POINT}>)"

    return (
        f"concat({points([p, *steps('alpha', 'alpha')])}, "
        f"if({p}.phi > 0, {points([*steps('trend', 'trend'), point('phi', f'{SOFTER!r}D')])}, {points([])}), "
        f"if({p}.season > 0, {points(steps('season', 'season'))}, {points([])}))"
    )


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v) / F.size(values)


def _starts(values: Column) -> Column:
    """Level, slope and weekly shape of the first four weeks."""
    m, head = S.SEASON, INIT_CYCLES * S.SEASON
    first = lambda i, n: F.slice(values, i + 1, n)
    at = lambda i: F.get(values, F.lit(i))
    return F.struct(
        _mean(first(0, head)).alias("level"),
        ((_mean(first(head // 2, head // 2)) - _mean(first(0, head // 2))) / (head // 2)).alias("slope"),
        F.array(*[reduce(Column.__add__, [at(c * m + i) for c in range(INIT_CYCLES)]) / INIT_CYCLES for i in range(m)]).alias("shape"),
    )


def _traced(p: str, ends: str, seasonal: bool) -> str:
    """Array of (n, now): the state of candidate ``p`` after the first n values, for each n of ``ends`` in order.

    ``push`` is the damped trend, ``known`` the level after it: the forecast of the day without its season. Next to
    the places of the week, the next day's first, run sums of squared errors, of squared relative errors and of the
    logarithms of the forecasts.
    """
    m, head = S.SEASON, INIT_CYCLES * S.SEASON
    slope = f"if({p}.phi > 0, _starts.slope, 0D)"
    places = [f"s{i}" for i in range(m)] if seasonal else []
    offsets = [
        f"if({p}.times, try_divide(_starts.shape[{i}], _starts.level), if({p}.season > 0, _starts.shape[{i}] - _starts.level, 0D))"
        for i in range(len(places))
    ]
    start = [f"_starts.level - {slope} * {(head + 1) / 2!r}D + {p}.phi * {slope}", f"{p}.phi * {slope}", *offsets, "0D", "0D", "0D"]
    state = ["known", "push", *places, "sse", "rse", "logs"]
    kind = f"array<struct<n:int,now:struct<{','.join(f'{c}:double' for c in state)}>>>"
    fit, inner, outer = "x.known", "day.error", "day.error"
    if seasonal:
        fit = f"if({p}.times, x.known * x.s0, x.known + x.s0)"
        inner, outer = (f"if({p}.times, try_divide(day.error, was.{c}), day.error)" for c in ("s0", "known"))
    beta = f"{p}.alpha * {p}.trend"
    rate = f"struct({p}.alpha + {p}.phi * {beta} as known, {p}.phi * {beta} as push, (1 - {p}.alpha) * {p}.season as season)"
    after = [
        f"was.known + {p}.phi * was.push + rate.known * {inner} as known",
        f"{p}.phi * was.push + rate.push * {inner} as push",
        *[f"was.{n} as {c}" for c, n in zip(places, places[1:])],
        *([f"was.s0 + rate.season * {outer} as {places[-1]}"] if seasonal else []),
        "was.sse + day.error * day.error as sse",
        "was.rse + try_divide(day.error, day.fit) * try_divide(day.error, day.fit) as rse",
        "was.logs + ln(if(day.fit > 0, day.fit, null)) as logs",
    ]
    # arrays of one, so that what is used again is computed once
    one_day = f"aggregate(transform(array({fit}), fit -> struct(fit as fit, y - fit as error)), x, (was, day) -> struct({', '.join(after)}))"
    days = "slice(values, element_at(seen, -1).n + 1, until - element_at(seen, -1).n)"
    note = f"array_append(seen, struct(until as n, aggregate({days}, element_at(seen, -1).now, (x, y) -> {one_day}) as now))"
    zero = f"cast(array(struct(0, struct({', '.join(start)}))) as {kind})"
    return f"slice(transform(array({rate}), rate -> aggregate({ends}, {zero}, (seen, until) -> {note}))[0], 2, size({ends}))"


def _scored(p: str, x: str) -> str:
    """(score, relative, p, x): the better corrected AIC of the two error forms; null where there is none."""
    # level, its start and the variance; a season adds its rate and six free offsets
    k = f"(3 + case when {p}.phi = 1 then 2 when {p}.phi > 0 then 3 else 0 end + if({p}.season > 0, 7, 0))"
    pay = f"2 * {k} + 2 * {k} * ({k} + 1) / ({x}.n - {k} - 1)"
    plain = f"if({p}.times, null, {x}.n * ln(greatest({x}.now.sse / {x}.n, 1e-300D)) + {pay})"
    relative = f"nanvl({x}.n * ln(greatest({x}.now.rse / {x}.n, 1e-300D)) + 2 * {x}.now.logs + {pay}, null)"
    return (
        f"transform(array(struct({plain} as plain, {relative} as rel)), s -> struct(nanvl(least(s.plain, s.rel), null) as score, "
        f"coalesce(s.plain > s.rel, s.plain is null) as relative, {p} as p, {x} as x))[0]"
    )


def smoothed(jobs: DataFrame, seasonal: bool, whole: bool = False) -> DataFrame:
    """One row per job and cutoff, with ``fit``: the best candidate on the days up to the cutoff.

    ``whole`` runs every point of ``whole_grid`` over all days instead of the halving search.

    ``jobs`` has values and stops, an array of (n, cutoff): the first n values count for that cutoff.
    Its other columns come along. Without ``seasonal`` no candidate has a season.
    """
    head = INIT_CYCLES * S.SEASON
    rows = jobs.withColumn("_ends", F.array_sort(F.array_distinct(F.filter("stops.n", lambda n: n >= head)))).filter(
        (F.size("values") >= head) & (F.size("_ends") > 0) & F.forall("values", lambda v: v.isNotNull())
    )
    rows = rows.withColumn("_starts", _starts(F.col("values")))
    # the search is written as text: parsed at once, where a column for each of its thousand nodes takes seconds
    tried = whole_grid(seasonal) if whole else coarse_grid(seasonal)
    grid = ", ".join(f"({a!r}D, {t!r}D, {s!r}D, {phi!r}D, {times})" for a, t, s, phi, times in tried)
    points = f"cast(array({grid}) as array<{_POINT}>)"
    for part, kept in {} if whole else RUNGS.items():
        until = f"array(least(_ends[0], greatest({RUNG_DAYS}, _ends[0] div {part})))".replace(" div ", " DIV ")
        tried = f"transform({points}, p -> transform({_traced('p', f'cast({until} as array<int>)', seasonal)}, x -> {_scored('p', 'x')})[0])"
        best = f"transform(slice(array_sort(filter({tried}, c -> c.score is not null)), 1, {kept}), c -> c.p)"
        rows = rows.withColumn(f"_kept{part}", F.expr(best))
        points = f"array_distinct(flatten(transform(_kept{part}, q -> {_neighbours('q')})))"
    points = points if whole else f"_kept{part}"
    rows = rows.withColumn("_runs", F.expr(f"flatten(transform({points}, p -> transform({_traced('p', '_ends', seasonal)}, x -> {_scored('p', 'x')})))"))
    mine = "array_min(filter(_runs, c -> c.x.n = _stop.n and c.score is not null))"
    rows = rows.withColumn("_stop", F.explode("stops")).withColumn("_best", F.expr(mine)).filter("_best is not null")
    trend = F.when(F.col("_best.p.phi") == 1, "A").when(F.col("_best.p.phi") > 0, "Ad").otherwise("N")
    season = F.when(F.col("_best.p.times"), "M").when(F.col("_best.p.season") > 0, "A").otherwise("N")
    fit = F.struct(
        F.concat(F.when(F.col("_best.relative"), "M").otherwise("A"), trend, season).alias("form"),
        "_best.p.alpha",
        (F.col("_best.p.alpha") * F.col("_best.p.trend")).alias("beta"),
        ((1 - F.col("_best.p.alpha")) * F.col("_best.p.season")).alias("gamma"),
        "_best.p.phi",
        "_best.p.times",
        "_best.x.n",
        "_best.x.now.*",
        F.sqrt(F.col("_best.x.now.sse") / F.col("_best.x.n")).alias("sigma"),
    )
    own = [c for c in jobs.columns if c not in ("values", "stops")]
    return rows.select(*own, F.col("_stop.cutoff").alias("cutoff"), fit.alias("fit"))


def _damped(steps: Column) -> Column:
    """phi + phi ** 2 + ... over a number of steps."""
    phi = F.col("fit.phi")
    return F.when(phi == 1, steps.cast("double")).otherwise(phi * (1 - F.pow(phi, steps)) / (1 - phi))


def ahead(fits: DataFrame, horizon: int, seasonal: bool) -> DataFrame:
    """The days after each cutoff: the columns of ``fits`` but ``fit``, with n, step, y_hat and error."""
    m, h = S.SEASON, F.col("step")
    # weight of an error i steps back on today's forecast
    carry = lambda i: F.col("fit.alpha") + F.col("fit.beta") * _damped(i) + F.when(i % m == 0, F.col("fit.gamma")).otherwise(0.0)
    earlier = F.slice(F.sequence(F.lit(1), F.lit(max(1, horizon))), F.lit(1), h - 1)
    spread = F.aggregate(earlier, F.lit(1.0), lambda total, i: total + F.pow(carry(i), F.lit(2.0)))
    level = F.col("fit.known") + F.col("fit.push") * _damped(h - 1)
    if seasonal:
        place = F.array(*[F.col(f"fit.s{i}") for i in range(m)])[(h - 1) % m]
        level = F.when(F.col("fit.times"), level * place).otherwise(level + place)
    own = [c for c in fits.columns if c != "fit"]
    return fits.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).select(
        *own, F.col("fit.n").alias("n"), "step", level.alias("y_hat"), (F.col("fit.sigma") * F.sqrt(spread)).alias("error")
    )


def packed(filled: DataFrame, origins: DataFrame) -> DataFrame:
    """(unique_id, values, stops): each gapless series as an array, with the days that count for each origin."""
    pairs = F.sort_array(F.collect_list(F.struct("ds", "y")))
    stops = origins.groupBy("unique_id").agg(F.collect_set("cutoff").alias("cutoffs"))
    return (
        filled.groupBy("unique_id")
        .agg(F.min("ds").alias("first"), F.transform(pairs, lambda p: p["y"].cast("double")).alias("values"))
        .join(stops, "unique_id")
        .select("unique_id", "values", F.transform("cutoffs", lambda c: F.struct(
            (F.datediff(c, F.col("first")) + 1).alias("n"), c.alias("cutoff"))).alias("stops"))
    )


def _dealt(jobs: DataFrame) -> DataFrame:
    """Rows dealt out in turn over a stated number of tasks, which is kept, so that few long series still use every core."""
    return jobs.repartition(4 * int(jobs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def smoothing_predictions(filled: DataFrame, origins: DataFrame, horizon: int, whole: bool = False) -> DataFrame:
    """``AutoETS``: (unique_id, cutoff, step, y_hat, error)."""
    return ahead(smoothed(_dealt(packed(filled, origins)), True, whole), horizon, True).drop("n")


def decomposed(filled: DataFrame, origins: DataFrame) -> DataFrame:
    """(unique_id, cutoff, n, values, season_7, season_365): what the seasons leave, and their last cycles."""
    jobs = packed(filled, origins).withColumn("stop", F.explode("stops")).select(
        "unique_id", F.col("stop.cutoff").alias("cutoff"), F.col("stop.n").alias("n"), F.slice("values", 1, F.col("stop.n")).alias("values")
    ).filter((F.col("n") >= MIN_DAYS["MSTL"]) & F.forall("values", lambda v: v.isNotNull()))
    return seasons_out(_dealt(jobs), SEASONS)


def decomposed_predictions(filled: DataFrame, origins: DataFrame, horizon: int, whole: bool = False) -> DataFrame:
    """``MSTL``: (unique_id, cutoff, step, y_hat, error)."""
    jobs = decomposed(filled, origins).withColumn("stops", F.array(F.struct("n", "cutoff"))).drop("n", "cutoff")
    out = ahead(smoothed(jobs, False, whole), horizon, False)
    for period in SEASONS:
        place = F.get(f"season_{period}", (F.col("step") - 1) % period)
        out = out.withColumn("y_hat", F.col("y_hat") + place)
    return out.select("unique_id", "cutoff", "step", "y_hat", "error")


def fitted_predictions(
    filled: DataFrame, origins: DataFrame, models: list[str], horizon: int = S.HORIZON, whole: bool = False
) -> DataFrame:
    """(unique_id, cutoff, model, ds, y_hat, error)."""
    by_model = {"AutoETS": smoothing_predictions, "MSTL": decomposed_predictions}
    parts = [by_model[m](filled, origins, horizon, whole).withColumn("model", F.lit(m)) for m in models]
    return reduce(DataFrame.unionByName, parts).select(
        "unique_id", "cutoff", "model", F.date_add("cutoff", F.col("step")).alias("ds"), "y_hat", "error"
    )


def predictions(
    filled: DataFrame, origins: DataFrame, models: list[str] = MODELS, horizon: int = S.HORIZON, whole: bool = False
) -> DataFrame:
    """(unique_id, model, cutoff, ds, y_hat) of all wanted models at the given origins."""
    cols = ["unique_id", "model", "cutoff", "ds", "y_hat"]
    parts = []
    if "SeasonalNaive" in models:
        naive = S.seasonal_naive(filled, origins, horizon)
        parts.append(naive.withColumn("model", F.lit("SeasonalNaive")).select(*cols))
    fitted = [m for m in models if m != "SeasonalNaive"]
    if fitted:
        parts.append(fitted_predictions(filled, origins, fitted, horizon, whole).select(*cols))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def backtest(
    series: DataFrame,
    models: list[str] = MODELS,
    horizon: int = S.HORIZON,
    windows: int = S.WINDOWS,
    whole: bool = False,
) -> DataFrame:
    """Rolling-origin predictions of observed days: (unique_id, model, cutoff, ds, y_hat, y).

    ``whole`` fits every candidate of ``whole_grid`` on all days.
    """
    filled = S.fill_days(series)
    origins = S.rolling_origins(series, horizon, windows)
    return S.with_truth(predictions(filled, origins, models, horizon, whole), series)


def demand_forecast(
    series: DataFrame, models: list[str] = MODELS, horizon: int = S.HORIZON, z: float = S.Z90
) -> DataFrame:
    """Next days per region and model with the 90 % band and the time of the run (UTC)."""
    filled = S.fill_days(series)
    cols = ["unique_id", "model", "ds", "y_hat", "lo", "hi"]
    parts = []
    if "SeasonalNaive" in models:
        parts.append(
            S.naive_forecast(filled, horizon, z=z)
            .withColumn("model", F.lit("SeasonalNaive"))
            .select(*cols)
        )
    fitted = [m for m in models if m != "SeasonalNaive"]
    if fitted:
        half = F.lit(z) * F.col("error")
        parts.append(
            fitted_predictions(filled, S.final_origin(filled), fitted, horizon)
            .withColumns({"lo": F.col("y_hat") - half, "hi": F.col("y_hat") + half})
            .select(*cols)
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return out.select(
        F.col("unique_id").alias("region"),
        F.col("ds").alias("forecast_date"),
        F.col("y_hat").alias("predicted_demand_mw"),
        F.col("lo").alias("lo_90"),
        F.col("hi").alias("hi_90"),
        "model",
        now.cast("timestamp_ntz").alias("generated_at"),
    )


def benchmark_predictions(
    train: DataFrame, models: list[str] = MODELS, horizon: int = S.HORIZON, engine: str = "Python"
) -> DataFrame:
    """(engine, model, region, ds, pred) of our models trained on the split's history."""
    filled = S.fill_days(train)
    return predictions(filled, S.final_origin(filled), models, horizon).select(
        F.lit(engine).alias("engine"), "model", F.col("unique_id").alias("region"), "ds",
        F.col("y_hat").alias("pred"),
    )


def external_predictions(rows: DataFrame, engine: str, model: str) -> DataFrame:
    """Another engine's output (quoted series name, stamped day) in the same shape."""
    from voltspan.functions.scalars import unquote

    return rows.select(
        F.lit(engine).alias("engine"),
        F.lit(model).alias("model"),
        unquote("series").alias("region"),
        F.to_date("ts").alias("ds"),
        F.col("forecast").alias("pred"),
    )
