"""Column expressions. Everything here stays inside Catalyst; there is no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
MARKET_REGIONS = ["NSW1", "QLD1", "VIC1", "SA1", "TAS1"]

# Settlement moved from 30 to 5 minutes after this interval-ending stamp.
FIVE_MINUTE_ERA = "2021-10-01 00:00:00"

# Text that stands for a null part of a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Fuel-tech rules, first match wins:
# (label, words looked for in the fuel text, words looked for in the technology text).
FUEL_RULES = [
    ("coal_brown", ["brown coal"], []),
    ("coal_black", ["coal"], []),
    ("battery", ["battery"], ["battery"]),
    ("hydro", ["water"], ["hydro"]),
    ("wind", ["wind"], ["wind"]),
    ("solar", ["solar"], ["photovoltaic"]),
    ("bioenergy", ["biomass", "bagasse", "landfill", "waste", "biogas", "wood", "sewage"], []),
    ("gas", ["gas", "fuel oil"], ["gas"]),
    ("distillate", ["diesel", "distillate", "oil", "kerosene"], []),
]
# Technology words that split the gas family, first match wins, else gas_other.
GAS_RULES = [
    ("gas_ccgt", ["combined cycle", "ccgt"]),
    ("gas_ocgt", ["open cycle", "ocgt"]),
    ("gas_steam", ["steam"]),
    ("gas_recip", ["reciprocating", "recip"]),
]
# ------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _rounded_sql(x: str, digits: int) -> str:
    scaled = f"(abs({x}) * 1e{digits}d)"
    whole = f"signum({x}) * floor({scaled} + 0.5d) / 1e{digits}d"
    return f"(case when {scaled} < {2**52}d then {whole} else {x} end)"


def round_half_away(x: str, digits: int = 0) -> Column:
    """Round a double, given as SQL text (a column name or an expression), half away from
    zero on its binary value.

    ``F.round`` rounds the printed decimal, so 1.005 would give 1.01 at two digits; the
    binary value lies below the tie and must give 1.00. Magnitudes beyond 2^52 units carry
    no further fraction and pass through, which also keeps the integer floor from
    overflowing on very large totals.
    """
    return F.expr(_rounded_sql(f"cast({x} as double)", digits))


def settle(x: str, digits: int) -> Column:
    """Round an inexact sum or mean: to six digits first, so that the order in which
    partitions were summed cannot tip a half-way case, then to the wanted digits."""
    return F.expr(_rounded_sql(_rounded_sql(f"cast({x} as double)", 6), digits))


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the dash-joined text of the columns; nulls count as a placeholder.

    ``concat_ws`` would skip nulls and let different keys collide.
    """
    parts: list[Column] = []
    for c in cols:
        if parts:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_PART)))
    return F.md5(F.concat(*parts))


def settlement_day(ts: Column | str) -> Column:
    """Calendar day of an interval-ending stamp: the 00:00 reading belongs to the new day."""
    return F.to_date(_col(ts))


def month_of(day: Column | str) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(_col(day), "MM")


def half_hour(ts: Column | str) -> Column:
    """Start of the 30-minute bucket that holds the stamp."""
    return F.window(_col(ts), "30 minutes")["start"]


def resolution_minutes(ts: Column | str, era: str = FIVE_MINUTE_ERA) -> Column:
    """5 strictly after the era stamp, otherwise (and for a null stamp) 30."""
    return F.when(_col(ts) > F.lit(era).cast("timestamp_ntz"), 5).otherwise(30)


def positive_part(x: Column | str) -> Column:
    """Clamp at zero; null counts as zero."""
    return F.greatest(_col(x), F.lit(0.0))


def mwh_from_mw(mw: Column | str, minutes: float = 5.0) -> Column:
    """Energy of a power reading that lasted ``minutes``."""
    return _col(mw) * F.lit(minutes / 60.0)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, null where the denominator is zero."""
    return num / F.nullif(den, F.lit(0.0))


def percent_error(actual: Column | str, predicted: Column | str) -> Column:
    """Absolute error in percent of the signed actual."""
    actual, predicted = _col(actual), _col(predicted)
    return safe_ratio(F.abs(actual - predicted), actual) * F.lit(100.0)


def squared_error(actual: Column | str, predicted: Column | str) -> Column:
    diff = _col(actual) - _col(predicted)
    return diff * diff


def unquote(c: Column | str) -> Column:
    """Drop the double quotes around a JSON-encoded name."""
    return F.btrim(_col(c), F.lit('"'))


def clean_text(c: Column | str) -> Column:
    """Trimmed text, empty for null."""
    return F.trim(F.coalesce(_col(c), F.lit("")))


def strict_stamp(c: Column | str) -> Column:
    """Parse ``yyyy/MM/dd HH:mm:ss``; malformed text raises."""
    return F.to_timestamp_ntz(_col(c), F.lit("yyyy/MM/dd HH:mm:ss"))


def stamp_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")


def file_month(path: Column | str, prefix: str) -> Column:
    """Six-digit load month that follows ``prefix`` in a file name, '' if absent."""
    return F.regexp_extract(_col(path), prefix + r"_(\d{6})", 1)


def classify_fueltech(fuel: str, technology: str) -> Column:
    """One of 14 fuel-tech labels from the two free-text columns."""
    fuel_text, tech_text = (f"lower(coalesce({c}, ''))" for c in (fuel, technology))

    def mentions(text: str, words: list[str]) -> str:
        return " or ".join(f"contains({text}, '{w}')" for w in words) or "false"

    gas = " ".join(f"when {mentions(tech_text, words)} then '{g}'" for g, words in GAS_RULES)
    gas = f"(case {gas} else 'gas_other' end)"
    arms = " ".join(
        f"when {mentions(fuel_text, in_fuel)} or {mentions(tech_text, in_tech)} then "
        + (gas if label == "gas" else f"'{label}'")
        for label, in_fuel, in_tech in FUEL_RULES
    )
    return F.expr(f"case {arms} else 'other' end")
