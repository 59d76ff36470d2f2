"""Raw rows -> clean, typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltspan.functions import scalars as X


def stg_price_demand(raw: DataFrame, era: str = X.FIVE_MINUTE_ERA) -> DataFrame:
    """Price and demand intervals with their native resolution flagged."""
    return raw.select(
        "region",
        "settlement_date",
        "total_demand_mw",
        "rrp_aud_mwh",
        "period_type",
        X.resolution_minutes("settlement_date", era).alias("resolution_min"),
        "source_month",
        "source_file",
    )


def stg_dispatch_scada(raw: DataFrame) -> DataFrame:
    """Unit readings with a value, cut at the start of the month of the newest stamp.

    A monthly file ends with the 00:00 reading of the next month; cutting there removes the
    spillover. The newest stamp is taken over the unfiltered rows, so data that ends inside
    a month loses that whole month. The bound is cast to the column's own type, otherwise
    the comparison would cast the column and never reach the file reader.
    """
    newest = raw.agg(
        F.date_trunc("month", F.max("settlement_date")).cast("timestamp_ntz")
    ).scalar()
    return raw.filter(
        F.col("scada_mw").isNotNull() & (F.col("settlement_date") < newest)
    ).select("settlement_date", "duid", "scada_mw", "source_month")
