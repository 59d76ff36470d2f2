"""Explicit schemas of everything that is landed. Nothing is ever inferred."""

from pyspark.sql import types as T


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


S, D, TS = T.StringType(), T.DoubleType(), T.TimestampNTZType()

# file layouts -----------------------------------------------------------------
PRICE_FILE = _schema(
    ("REGION", S), ("SETTLEMENTDATE", S), ("TOTALDEMAND", D), ("RRP", D), ("PERIODTYPE", S)
)
# Mixed record types with differing field counts: ten text columns, short rows padded.
RECORD_FILE = _schema(*[(f"col{i}", S) for i in range(10)])
REGISTRY_COLUMNS = [
    "DUID", "Station Name", "Region", "Dispatch Type",
    "Fuel Source - Descriptor", "Technology Type - Descriptor", "Reg Cap generation (MW)",
]

# tables -----------------------------------------------------------------------
PRICE_DEMAND = _schema(
    ("region", S), ("settlement_date", TS), ("total_demand_mw", D), ("rrp_aud_mwh", D),
    ("period_type", S), ("source_month", S), ("source_file", S),
)
DISPATCH_SCADA = _schema(
    ("settlement_date", TS), ("duid", S), ("scada_mw", D), ("source_month", S)
)
REGION = _schema(("region_id", S), ("region_name", S), ("state", S), ("timezone", S))
FUELTECH = _schema(
    ("fueltech", S), ("fueltech_label", S), ("fuel_group", S), ("is_renewable", S),
    ("emission_factor_t_co2_per_mwh", S),
)
UNIT = _schema(
    ("duid", S), ("station_name", S), ("region", S), ("dispatch_type", S),
    ("fuel_source", S), ("technology", S), ("fueltech", S), ("reg_cap_mw", S),
)
ENGINE_BENCHMARK = _schema(
    ("region", S), ("engine", S), ("model", S), ("mae", S), ("rmse", S), ("mape", S),
    ("holdout_start", S), ("holdout_end", S),
)
PRICE_ANOMALY = _schema(
    ("region", S), ("settlement_day", S), ("avg_rrp", S), ("expected_rrp", S),
    ("lower_bound", S), ("upper_bound", S), ("is_anomaly", S), ("distance", S),
)
EXTERNAL_PREDICTION = _schema(("series", S), ("ts", TS), ("forecast", D))
