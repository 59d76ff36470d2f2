"""Series, forecasts and anomalies on small series with known answers."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltspan.operators import anomalies, decompose, forecast, series

D0 = dt.date(2024, 1, 1)


def frame(spark, data):
    rows = [(k, D0 + dt.timedelta(days=i), float(v)) for k, vs in data.items()
            for i, v in enumerate(vs) if v is not None]
    return spark.createDataFrame(rows, "unique_id string, ds date, y double")


def test_partial_day_guard(spark):
    rows = [("SA1", D0, 39, 1.0), ("SA1", D0 + dt.timedelta(1), 40, 2.0),
            ("SA1", D0 + dt.timedelta(2), 47, 3.0)]
    df = spark.createDataFrame(
        rows, "region string, settlement_day date, interval_count long, avg_demand_mw double")
    assert sorted(r.y for r in series.daily_series(df).collect()) == [2.0, 3.0]


def test_fill_days_carries_forward(spark):
    got = series.fill_days(frame(spark, {"a": [1, None, None, 4]})).orderBy("ds").collect()
    assert [r.y for r in got] == [1.0, 1.0, 1.0, 4.0]
    assert len({r.ds for r in got}) == 4


def test_origins_and_naive(spark):
    df = frame(spark, {"a": range(60), "b": range(30)})
    origins = series.rolling_origins(df)
    assert origins.count() == 12
    assert origins.agg(F.max("cutoff")).first()[0] == D0 + dt.timedelta(days=52)
    scored = series.with_truth(series.seasonal_naive(df, origins), df)
    # a ramp is always seven behind
    assert {r.y - r.y_hat for r in scored.collect()} == {7.0}
    # series b reaches back to day -13 for its earliest origins: those predictions drop out
    assert scored.filter("unique_id = 'a'").count() == 42


def test_naive_beyond_one_season_repeats(spark):
    df = frame(spark, {"a": range(14)})
    got = series.naive_forecast(df, horizon=9).orderBy("ds").collect()
    assert [r.y_hat for r in got] == [7, 8, 9, 10, 11, 12, 13, 7, 8]
    width = [r.hi - r.lo for r in got]
    assert width == sorted(width) and width[7] == pytest.approx(width[0] * math.sqrt(2))


def test_error_scores(spark):
    rows = [("a", "m", 10.0, 9.0), ("a", "m", -20.0, -22.0), ("b", "m", 0.0, 1.0)]
    df = spark.createDataFrame(rows, "region string, model string, y double, y_hat double")
    got = {r.region: (r.mae, r.rmse, r.mape) for r in
           series.error_scores(df, ["region", "model"]).collect()}
    # the signed actual divides: +10 % and -10 % cancel; a zero actual has no percentage
    assert got == {"a": (1.5, 1.6, 0.0), "b": (1.0, 1.0, None)}


def test_best_model_tie_goes_to_the_first(spark):
    rows = [("a", "X", 2.0), ("a", "Y", 2.0), ("b", "X", 3.0), ("b", "Y", 1.0)]
    df = spark.createDataFrame(rows, "region string, model string, mape double")
    for order in (["X", "Y"], ["Y", "X"]):
        got = {r.region: r.model for r in series.best_model(df, order).collect()}
        assert got == {"a": order[0], "b": "Y"}


def test_published_benchmark_means(spark):
    """Mean MAPE per model of the published comparison, and the regional winners."""
    # fixed values: region, model, mape
    mape = {
        "HOSTED": [4.75, 3.64, 1.94, 4.72, 1.67], "SeasonalNaive": [2.92, 6.4, 11.53, 8.91, 2.01],
        "AutoETS": [2.04, 3.3, 5.53, 5.34, 3.83], "MSTL": [4.54, 3.63, 5.68, 5.79, 3.23],
    }
    regions = ["NSW1", "QLD1", "SA1", "TAS1", "VIC1"]
    rows = [(r, "e", m, v) for m, vs in mape.items() for r, v in zip(regions, vs)]
    df = spark.createDataFrame(rows, "region string, engine string, model string, mape double")
    assert [(r.model, r.avg_mape) for r in series.mean_score(df).collect()] == [
        ("HOSTED", 3.34), ("AutoETS", 4.01), ("MSTL", 4.57), ("SeasonalNaive", 6.35)]
    best = {r.region: r.model for r in series.best_model(df, list(mape)).collect()}
    assert best == {"NSW1": "AutoETS", "QLD1": "AutoETS", "SA1": "HOSTED", "TAS1": "HOSTED",
                    "VIC1": "HOSTED"}
    gain = {(r.region, r.model): r.gain for r in series.gain_over_baseline(df).collect()}
    assert gain["NSW1", "AutoETS"] == pytest.approx((2.92 - 2.04) / 2.92, abs=1e-6)
    pivot = {r.region: r.asDict() for r in series.mape_pivot(df, list(mape)).collect()}
    assert pivot["SA1"]["HOSTED"] == 1.94


def brute_trace(y, p, horizon=7):
    """One candidate in plain Python: (score, relative error form) and the days ahead."""
    alpha, trend, season, phi, times = p
    beta, gamma = alpha * trend, (1 - alpha) * season
    slope = (np.mean(y[14:28]) - np.mean(y[:14])) / 14 if phi > 0 else 0.0
    level0 = np.mean(y[:28])
    shape = [np.mean(y[i:28:7]) for i in range(7)]
    offs = [v / level0 if times else v - level0 if season > 0 else 0.0 for v in shape]
    level, sse, rse, logs = level0 - slope * 29 / 2, 0.0, 0.0, 0.0
    for t, v in enumerate(y):
        base = level + phi * slope
        fit = base * offs[t % 7] if times else base + offs[t % 7]
        e = v - fit
        inner, outer = (e / offs[t % 7], e / base) if times else (e, e)
        level, slope = base + alpha * inner, phi * slope + beta * inner
        offs[t % 7] += gamma * outer
        sse, rse, logs = sse + e * e, rse + (e / fit) ** 2, logs + (math.log(fit) if fit > 0 else math.nan)
    n, k = len(y), 3 + (2 if phi == 1 else 3 if phi > 0 else 0) + (7 if season > 0 else 0)
    pay = 2 * k + 2 * k * (k + 1) / (n - k - 1)
    plain = math.inf if times else n * math.log(max(sse / n, 1e-300)) + pay
    relative = n * math.log(max(rse / n, 1e-300)) + 2 * logs + pay
    relative = math.inf if math.isnan(relative) else relative
    ahead = [level + sum(phi**j for j in range(1, h + 1) if phi > 0) * slope for h in range(1, horizon + 1)]
    steps = [v * offs[(n + h) % 7] if times else v + offs[(n + h) % 7] for h, v in enumerate(ahead)]
    return (min(plain, relative), plain > relative, p), steps


def brute_force(y, first, seasonal):
    """The same search, one candidate after the other; ``first`` is the day of the earliest origin."""
    points = list(forecast.coarse_grid(seasonal))
    for i, (part, kept) in enumerate(forecast.RUNGS.items()):
        until = min(first, max(forecast.RUNG_DAYS, first // part))
        points = [p for _, _, p in sorted(brute_trace(y[:until], p)[0] for p in points)[:kept]]
        if i == 0:
            top, near = forecast.CEILING, list(points)
            for a, t, s, phi, times in points:
                near += [(min(a * f, top), t, s, phi, times) for f in forecast.STEPS["alpha"]]
                near += [(a, min(t * f, top), s, phi, times) for f in forecast.STEPS["trend"] if phi > 0]
                near += [(a, t, s, forecast.SOFTER, times) for _ in (1,) if phi > 0]
                near += [(a, t, min(s * f, top), phi, times) for f in forecast.STEPS["season"] if s > 0]
            points = sorted(set(near))
    return min((brute_trace(y, p) for p in points), key=lambda x: x[0])


@pytest.mark.parametrize(("seasonal", "times"), [(True, False), (True, True), (False, False)])
def test_smoothing_matches_brute_force(spark, seasonal, times):
    rng = np.random.default_rng(3)
    t = np.arange(700)
    wave = np.sin(2 * np.pi * t / 7) * (seasonal > 0)
    y = (100 + 0.5 * t) * (1 + 0.3 * wave) + rng.normal(0, 2, 700) if times else 100 + 0.2 * t + 10 * wave + rng.normal(0, 2, 700)
    stops = ", ".join(f"named_struct('n', {n}, 'cutoff', date_add(date'2024-01-01', {n - 1}))" for n in (700, 690))
    jobs = spark.createDataFrame([("a", y.tolist())], "unique_id string, values array<double>").selectExpr(
        "*", f"array({stops}) as stops")
    fits = forecast.smoothed(jobs, seasonal).collect()
    got = forecast.ahead(forecast.smoothed(jobs, seasonal), 7, seasonal).orderBy("n", "step").collect()
    assert len(fits) == 2
    for n, rows in ((690, got[:7]), (700, got[7:])):
        (_, relative, (alpha, trend, season, phi, by)), want = brute_force(y[:n], 690, seasonal)
        fit = next(r.fit for r in fits if r.fit.n == n)
        assert (fit.alpha, fit.beta, fit.gamma, fit.phi) == pytest.approx((alpha, alpha * trend, (1 - alpha) * season, phi))
        assert (fit.form[0] == "M", fit.times) == (relative, by) and by == times
        assert [r.y_hat for r in rows] == pytest.approx(want)
        assert [r.error for r in rows] == sorted(r.error for r in rows)


@pytest.mark.parametrize("y", [
    # the week starts after what the halving search reads first; the level moves late
    [100 + 0.1 * i + (12 * math.sin(2 * math.pi * i / 7) if i > 330 else 0) + math.cos(i * i) for i in range(420)],
    [100 + math.cos(i * i) + (30 * math.sin(i / 9) if i > 250 else 0) for i in range(420)],
])
def test_whole_search_tries_every_candidate_on_all_days(spark, y):
    df = frame(spark, {"a": y})
    got = forecast.backtest(df, ["AutoETS"], windows=1, whole=True).orderBy("ds").collect()
    halved = forecast.backtest(df, ["AutoETS"], windows=1).orderBy("ds").collect()
    points = forecast.whole_grid(True)
    assert len(points) == len(set(points)) > 700 and set(forecast.coarse_grid(True)) < set(points)
    _, want = min((brute_trace(y[:413], p) for p in points), key=lambda x: x[0])
    assert [r.y_hat for r in got] == pytest.approx(want)
    assert [r.y_hat for r in halved] != pytest.approx(want)


def test_series_that_reach_zero_have_no_relative_errors(spark):
    y = [float(i % 7) - 3 for i in range(90)]
    jobs = spark.createDataFrame([("a", y), ("b", y[:20]), ("c", [None, *y])], "unique_id string, values array<double>").selectExpr(
        "*", "array(named_struct('n', 90, 'cutoff', date'2024-01-01'), named_struct('n', 27, 'cutoff', date'2023-01-01')) as stops")
    rows = forecast.smoothed(jobs, True).collect()
    assert [(r.unique_id, r.fit.n, r.fit.form[0], r.fit.times) for r in rows] == [("a", 90, "A", False)]


def test_origins_before_a_series_or_too_early_get_no_row(spark):
    df = frame(spark, {"a": [float(i % 7) for i in range(40)], "b": [1.0] * 20})
    got = forecast.backtest(df, ["AutoETS", "MSTL"]).collect()
    # the origins of a are its days 33, 26, 19, 12, 5 and the second before its first
    assert {(r.unique_id, r.model, r.cutoff) for r in got} == {("a", "AutoETS", D0 + dt.timedelta(32))}
    assert len(got) == 7 and all(r.y_hat == pytest.approx(r.y, abs=0.5) for r in got)


def test_decomposition_recovers_both_seasons(spark):
    t = np.arange(365 * 4)
    y = 300 + 5 * np.sin(2 * np.pi * t / 7) + 20 * np.cos(2 * np.pi * t / 365)
    fc = forecast.demand_forecast(frame(spark, {"a": y, "brief": y[:729]}), ["MSTL"]).orderBy("forecast_date").collect()
    assert {r.region for r in fc} == {"a"}  # two whole years are the least
    ahead = np.arange(len(t), len(t) + 7)
    truth = 300 + 5 * np.sin(2 * np.pi * ahead / 7) + 20 * np.cos(2 * np.pi * ahead / 365)
    assert np.abs(np.array([r.predicted_demand_mw for r in fc]) - truth).max() < 1.0


def brute_loess(y, q, jump, beyond=0):
    """Weighted least squares by numpy at each fitted place, straight lines between."""
    n, first, last = len(y), -beyond, len(y) - 1 + beyond
    places = sorted({*range(first, last + 1, jump), last})
    fits = []
    for i in places:
        near = sorted(range(n), key=lambda j: (abs(j - i), j))[:q]
        far = max(abs(j - i) for j in near) + max(0, q - n) // 2
        w = [(1 - (abs(j - i) / far) ** 3) ** 3 if abs(j - i) <= 0.999 * far else 0.0 for j in near]
        if sum(x > 0 for x in w) < 2:
            fits.append(np.average([y[j] for j in near], weights=w))
        else:
            fits.append(np.polyval(np.polyfit(near, [y[j] for j in near], 1, w=np.sqrt(w)), i))
    return np.interp(range(first, last + 1), places, fits)


@pytest.mark.parametrize(("n", "q", "jump", "beyond"), [(40, 7, 1, 0), (41, 13, 2, 0), (6, 15, 2, 1), (30, 11, 2, 1), (1, 11, 2, 1), (100, 61, 7, 0)])
def test_local_regression_against_least_squares(n, q, jump, beyond):
    y = np.random.default_rng(n).normal(0, 5, n)
    assert decompose.loess(y, q, jump, beyond) == pytest.approx(brute_loess(y, q, jump, beyond), abs=1e-7)


def test_both_seasons_are_taken_out(spark):
    rng = np.random.default_rng(8)
    t = np.arange(61)
    y = 50 + t + np.array([3.0, -1.0, 0.0, 2.0, -4.0])[t % 5] + np.sin(2 * np.pi * t / 12) + rng.normal(0, 0.2, 61)
    mean = lambda v, k: np.array([np.mean(v[i : i + k]) for i in range(len(v) - k + 1)])
    rest, want = y, {}
    for period, cycles in ((5, 11), (12, 15)):
        trend, wide = np.zeros(61), decompose.windows(period, cycles)
        for _ in range(2):
            longer = np.zeros(61 + 2 * period)
            for i in range(period):
                longer[i::period] = brute_loess((rest - trend)[i::period], cycles, 2, 1)
            low = mean(mean(mean(longer, period), period), 3)
            season = longer[period:-period] - brute_loess(low, wide["low"], decompose.jump_of(wide["low"]))
            trend = brute_loess(rest - season, wide["trend"], decompose.jump_of(wide["trend"]))
        rest, want[period] = rest - season, season[-period:]
    jobs = spark.createDataFrame([("a", y.tolist(), 61), ("b", (2 * y).tolist(), 61)], "unique_id string, values array<double>, n int")
    got = {r.unique_id: r for r in decompose.seasons_out(jobs, (5, 12)).collect()}
    for name, factor in (("a", 1), ("b", 2)):
        assert got[name]["values"] == pytest.approx(factor * rest, abs=1e-6)
        assert got[name].season_5 == pytest.approx(factor * want[5], abs=1e-6)
        assert got[name].season_12 == pytest.approx(factor * want[12], abs=1e-6)


def test_forecast_job(spark):
    rng = np.random.default_rng(5)
    t = np.arange(140)
    wave = 100 + 20 * np.sin(2 * np.pi * t / 7)
    data = {"calm": wave + rng.normal(0, 1, 140), "flat": [50.0] * 140,
            "short": [1.0, 2.0, 3.0, 4.0], "gap": [None if i % 10 == 3 else v
                                                  for i, v in enumerate(wave)]}
    df = frame(spark, data)
    fc = forecast.demand_forecast(df).collect()
    # a series without one full season has baseline values only for the days it knows, no band
    part = [r for r in fc if r.region == "short" and r.model == "SeasonalNaive"]
    assert [r.predicted_demand_mw for r in part] == [1.0, 2.0, 3.0, 4.0]
    assert {r.lo_90 for r in part} == {None}
    fc = [r for r in fc if r not in part]
    for r in fc:
        assert r.lo_90 <= r.predicted_demand_mw <= r.hi_90
    got = {(r.region, r.model): 0 for r in fc}
    # no model answers for a series shorter than its minimum
    assert {m for r, m in got if r == "calm"} == {"SeasonalNaive", "AutoETS"}
    assert not [m for r, m in got if r == "short"]
    flat = [r for r in fc if r.region == "flat"]
    assert all(r.predicted_demand_mw == pytest.approx(50.0, abs=1e-6) for r in flat)
    for key in got:
        rows = sorted((r for r in fc if (r.region, r.model) == key), key=lambda r: r.forecast_date)
        widths = [r.hi_90 - r.lo_90 for r in rows]
        assert all(b >= a - 1e-9 for a, b in zip(widths, widths[1:]))
    shuffled = forecast.demand_forecast(df.orderBy(F.rand(1)).repartition(7)).drop("generated_at")
    same = forecast.demand_forecast(df).drop("generated_at")
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, shuffled.collect()))


def test_backtest_beats_a_wrong_baseline(spark):
    t = np.arange(200)
    y = 100 + 3.0 * t + 5 * np.sin(2 * np.pi * t / 7)
    scores = series.accuracy_table(forecast.backtest(frame(spark, {"a": y})))
    got = {r.model: r for r in scores.collect()}
    assert got["SeasonalNaive"].mae == 21.0
    assert got["AutoETS"].mae < 1.0 and set(got) == {"SeasonalNaive", "AutoETS"}
    assert {r.n_windows for r in got.values()} == {6}


def test_engine_benchmark_uses_one_cutoff(spark):
    df = frame(spark, {"a": range(40), "late": list(range(39))})
    train, holdout = series.holdout_split(df)
    # the cutoff is global: the series that ends a day early has six holdout days
    assert {r["unique_id"]: r["n"] for r in
            holdout.groupBy("unique_id").agg(F.count("*").alias("n")).collect()} == {"a": 7, "late": 6}
    preds = forecast.benchmark_predictions(train, ["SeasonalNaive"])
    got = {r.region: r for r in series.engine_benchmark(holdout, preds).collect()}
    assert got["a"].mae == got["late"].mae == 7.0
    assert got["a"].holdout_end == D0 + dt.timedelta(days=39)
    assert got["a"].holdout_start == D0 + dt.timedelta(days=33)


def test_anomalies(spark):
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=i) for i in range(730)]
    rows = [("SA1", d, 50.0 + (i % 5), 48) for i, d in enumerate(days)]
    spike = dt.date(2024, 6, 12)
    rows = [(r, d, 2457.0 if d == spike else v, n) for r, d, v, n in rows]
    df = spark.createDataFrame(
        rows, "region string, settlement_day date, avg_rrp double, interval_count int")
    scored = anomalies.score_prices(df, "2023-12-31")
    assert scored.count() == 365
    top = anomalies.top_flagged(scored, 3).collect()
    assert top[0].settlement_day == spike and top[0].distance > 100
    rate = anomalies.flag_rate(scored).first()
    assert rate.scored == 365 and 1 <= rate.flagged < 40
    # a month never seen in training falls back to the region's mean
    short = anomalies.score_prices(df.filter("settlement_day < '2024-03-01'"), "2023-02-28")
    assert short.filter("expected_rrp is null").count() == 0


def test_region_without_training_days_keeps_its_scores(spark):
    rows = [("NEW", dt.date(2024, 3, d), 50.0) for d in range(1, 6)]
    rows += [("OLD", dt.date(2023, 3, d), 40.0 + d) for d in range(1, 20)]
    df = spark.createDataFrame(rows, "region string, settlement_day date, avg_rrp double")
    got = anomalies.score_prices(df, "2023-12-31").collect()
    assert len(got) == 5 and all(r.lower_bound is None and r.is_anomaly is False for r in got)
