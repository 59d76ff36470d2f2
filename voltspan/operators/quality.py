"""Data-quality checks. Each returns the failing keys with the number of failing rows.

Every check reduces the table by key with map-side combining, so a hot key is one row per task and a
join against a parent moves distinct keys. A check of a key that hardly repeats still shuffles every
key, though no other column. A summary reads a table once for all its checks of single rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltspan.session import maybe_broadcast, stage


def _not_in(col: str, values: list) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(values)


def _outside(col: str, low: float, high: float) -> Column:
    return (F.col(col) < low) | (F.col(col) > high)


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull()).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 0")


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once; nulls are not compared."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Values outside the list; null passes."""
    return df.filter(_not_in(col, values)).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child values without a parent row; null passes. Both sides are reduced to distinct keys
    first, so the adaptive planner can choose the join from their real sizes."""
    keys = (
        child.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_col).alias(col)).distinct()
    return keys.join(known, col, "left_anti")


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """Column combinations that occur more than once; nulls compare as equal."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def accepted_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Values below ``low`` or above ``high``, bounds allowed; null passes."""
    return (
        df.filter(_outside(col, low, high))
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@dataclass(frozen=True)
class Check:
    """A named check on a table. ``needs`` lists the tables it reads."""

    table: str
    name: str
    needs: tuple[str, ...]
    spec: tuple  # kind of check and its arguments
    failing: Callable[[dict[str, DataFrame]], DataFrame]

    def row_fails(self) -> Column | None:
        """When a row fails, for checks that look at one row; None for those of keys."""
        kind, *args = self.spec
        if kind == "not_null":
            return F.col(args[0]).isNull()
        if kind == "values":
            return _not_in(*args)
        return _outside(*args) if kind == "range" else None


def _check(table: str, name: str, spec: tuple, fn, *more: str) -> Check:
    return Check(table, name, (table, *more), spec, fn)


def nn(table: str, *cols: str) -> list[Check]:
    return [
        _check(table, f"not_null_{c}", ("not_null", c), lambda t, c=c: not_null(t[table], c))
        for c in cols
    ]


def uq(table: str, col: str) -> Check:
    return _check(table, f"unique_{col}", ("unique", col), lambda t: unique(t[table], col))


def fk(table: str, col: str, parent: str, parent_col: str) -> Check:
    return _check(
        table, f"relationships_{col}_{parent}", ("relationship", col, parent, parent_col),
        lambda t: relationships(t[table], col, t[parent], parent_col), parent,
    )


def combo(table: str, *cols: str) -> Check:
    return _check(
        table, "unique_" + "_".join(cols), ("combination", *cols),
        lambda t: unique_combination(t[table], list(cols)),
    )


def av(table: str, col: str, values: list) -> Check:
    return _check(
        table, f"accepted_values_{col}", ("values", col, values),
        lambda t: accepted_values(t[table], col, values),
    )


def rng(table: str, col: str, low: float, high: float) -> Check:
    return _check(
        table, f"accepted_range_{col}", ("range", col, low, high),
        lambda t: accepted_range(t[table], col, low, high),
    )


def standard_checks() -> list[Check]:
    """The checks every build must pass, table by table."""
    from voltspan.functions.scalars import MARKET_REGIONS
    from voltspan.operators.forecast import MODELS
    from voltspan.sources.reference import BENCHMARK_ENGINES

    region = ("dim_region", "region_id")
    fuel = ("dim_fueltech", "fueltech")
    return [
        # seeds
        *nn("seed_region", "region_id"), uq("seed_region", "region_id"),
        *nn("seed_fueltech", "fueltech"), uq("seed_fueltech", "fueltech"),
        *nn("seed_duid_fueltech", "duid"), uq("seed_duid_fueltech", "duid"),
        # staging
        *nn("stg_price_demand", "region", "settlement_date", "rrp_aud_mwh", "total_demand_mw"),
        av("stg_price_demand", "region", MARKET_REGIONS),
        av("stg_price_demand", "resolution_min", [5, 30]),
        combo("stg_price_demand", "region", "settlement_date"),
        *nn("stg_dispatch_scada", "duid", "settlement_date"),
        # dimensions
        *nn("dim_region", "region_id"), uq("dim_region", "region_id"),
        *nn("dim_fueltech", "fueltech", "is_renewable"), uq("dim_fueltech", "fueltech"),
        *nn("dim_duid", "duid", "region", "fueltech"), uq("dim_duid", "duid"),
        fk("dim_duid", "region", *region), fk("dim_duid", "fueltech", *fuel),
        # facts; the price bounds catch scale errors, they do not track the market cap
        *nn("fct_price_demand", "price_demand_id", "region", "settlement_date", "rrp_aud_mwh"),
        uq("fct_price_demand", "price_demand_id"), fk("fct_price_demand", "region", *region),
        rng("fct_price_demand", "rrp_aud_mwh", -1000, 40000),
        *nn("fct_region_daily", "region", "settlement_day"),
        fk("fct_region_daily", "region", *region),
        combo("fct_region_daily", "region", "settlement_day"),
        *nn("fct_generation", "region", "fueltech", "interval_start"),
        fk("fct_generation", "region", *region), fk("fct_generation", "fueltech", *fuel),
        combo("fct_generation", "region", "fueltech", "interval_start"),
        combo("fct_generation_daily", "region", "fueltech", "settlement_day"),
        *nn("fct_region_energy_daily", "region"),
        fk("fct_region_energy_daily", "region", *region),
        rng("fct_region_energy_daily", "renewable_share_pct", 0, 100),
        combo("fct_region_energy_daily", "region", "settlement_day"),
        # model results
        *nn("fct_demand_forecast", "region", "forecast_date", "predicted_demand_mw"),
        fk("fct_demand_forecast", "region", *region),
        av("fct_demand_forecast", "model", MODELS),
        combo("fct_demand_forecast", "region", "model", "forecast_date"),
        *nn("fct_engine_benchmark", "region"), fk("fct_engine_benchmark", "region", *region),
        av("fct_engine_benchmark", "engine", BENCHMARK_ENGINES),
        rng("fct_engine_benchmark", "mape", 0, 100),
        combo("fct_engine_benchmark", "region", "model"),
        *nn("fct_price_anomalies", "region", "settlement_day", "is_anomaly"),
        fk("fct_price_anomalies", "region", *region),
        combo("fct_price_anomalies", "region", "settlement_day"),
        *nn("fct_forecast_accuracy", "region"), fk("fct_forecast_accuracy", "region", *region),
        rng("fct_forecast_accuracy", "mape", 0, 100),
        combo("fct_forecast_accuracy", "region", "model"),
    ]


def selectable(checks: list[Check], tables: dict[str, DataFrame]) -> list[Check]:
    """Only the checks whose tables are all part of this build."""
    return [c for c in checks if all(n in tables for n in c.needs)]


def run_checks(checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, check_name, failures): one row per check, in one query.

    All checks of single rows of a table are counted in one scan of it. Checks whose tables aren't
    part of the build are left out; ``skipped`` names them.
    """
    rows: dict[str, list[tuple[str, Column]]] = {}
    parts = []
    for c in selectable(checks, tables):
        fails = c.row_fails()
        if fails is not None:
            rows.setdefault(c.table, []).append((c.name, F.count_if(fails)))
            continue
        parts.append(
            c.failing(tables)
            .agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("failures"))
            .select(F.lit(c.table).alias("table_name"), F.lit(c.name).alias("check_name"), "failures")
        )
    for table, counts in rows.items():
        results = [
            F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("check_name"), F.col(name).alias("failures"))
            for name, _ in counts
        ]
        once = tables[table].agg(*[n.alias(name) for name, n in counts])
        parts.append(once.select(F.inline(F.array(*results))))
    return reduce(DataFrame.unionByName, parts)


def skipped(checks: list[Check], tables: dict[str, DataFrame]) -> list[Check]:
    """The checks that ``run_checks`` leaves out for want of a table."""
    return [c for c in checks if not all(n in tables for n in c.needs)]


def gate(summary: DataFrame) -> DataFrame:
    """Raise with the names of the failing checks, if any; else the summary as it was found.

    The summary has a row per check, and the checks run once.
    """
    found = summary.collect()
    failed = [r for r in found if r.failures]
    if failed:
        names = ", ".join(f"{r.table_name}.{r.check_name}={r.failures}" for r in failed)
        raise AssertionError(f"data checks failed: {names}")
    return summary.sparkSession.createDataFrame(found, summary.schema)


Level = Mapping[str, Column]


def _differing(left: DataFrame, right: DataFrame, level: Level) -> DataFrame:
    """The groups of a level in which the two builds differ, by sums that don't depend on order.

    A row counts for itself and with two digests of all its columns, added on the left and taken away on
    the right, so a group of equal rows sums to nothing. Groups are combined per task; no row is shuffled.
    """
    columns = left.columns
    digests = {"_n": F.lit(1), "_a": F.xxhash64(*columns), "_b": F.xxhash64(F.lit("second"), *columns)}

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*[c.alias(n) for n, c in level.items()], *[(c.cast("decimal(20,0)") * sign).alias(n) for n, c in digests.items()])

    both = signed(left, 1).unionByName(signed(right, -1))
    sums = both.groupBy(*level).agg(*[F.sum(n).alias(n) for n in digests])
    return sums.filter("_n <> 0 or _a <> 0 or _b <> 0").select(*level)


def differing_parts(left: DataFrame, right: DataFrame, levels: Sequence[Level]) -> tuple[DataFrame, DataFrame]:
    """Both builds cut down, level by level, to the groups that differ.

    A level names its groups by columns over a build's row, coarse ones first. Groups whose digests agree are
    left out, which overlooks a difference with a chance of one in 2**128 or so.
    """
    for level in levels:
        groups = maybe_broadcast(stage(_differing(left, right, level), "differing-groups"))
        names = {n: f"_group_{n}" for n in level}
        groups = groups.withColumnsRenamed(names)

        def within(df: DataFrame) -> DataFrame:
            on = reduce(lambda p, q: p & q, [c.eqNullSafe(F.col(names[n])) for n, c in level.items()])
            return df.join(groups, on, "left_semi")

        left, right = within(left), within(right)
    return left, right


def mart_difference(left: DataFrame, right: DataFrame, levels: Sequence[Level] = ()) -> DataFrame:
    """Rows found in one build only, duplicates counted, tagged with the side.

    With ``levels`` only rows of groups that differ are compared, and shuffled, one by one.
    """
    left, right = differing_parts(left, right.select(*left.columns), levels)
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(
        right.exceptAll(left).withColumn("side", F.lit("right"))
    )


def aggregate_difference(
    left: DataFrame, right: DataFrame, keys: list[str], aggs: dict[str, Column]
) -> DataFrame:
    """Compare the same aggregates of two builds; returns the keys where they differ."""
    a = left.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    b = right.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return mart_difference(a, b)
