"""The demo fleet: plants × units × sensor specs → the 184-sensor dimension.

The tables below are small literals; the expansion itself is a Spark plan
(joins plus ``explode(sequence(...))``, see ``operators.expand``).  Used by
tests and examples; not a registered query, since it reads no input table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators.expand import expand_dimension

# ---- fixed values (must equal the demo fleet for ids, tags and bands) -------
# Plants: site_code, plant_name, type, country.
PLANTS = [
    ("NRDG", "North Ridge Wind", "onshore_wind", "Ireland"),
    ("GLNF", "Glenfield Wind", "onshore_wind", "Spain"),
    ("HVNW", "Havenwater Offshore", "offshore_wind", "Netherlands"),
    ("STBK", "Stormbank Offshore", "offshore_wind", "United Kingdom"),
    ("SUNV", "Sunvale Solar Park", "solar_pv", "Spain"),
    ("DSRT", "Desert Mesa Solar", "solar_pv", "Portugal"),
    ("IRON", "Irongate BESS", "battery", "United Kingdom"),
    ("HRBR", "Harbor Point BESS", "battery", "Ireland"),
]
# Plant type: energy_source, business_category, unit_prefix, sampled units per site, equipment family.
TYPE_META = [
    ("onshore_wind", "wind", "Onshore Wind", "WTG", 5, "wind"),
    ("offshore_wind", "wind", "Offshore Wind", "WTG", 5, "wind"),
    ("solar_pv", "solar", "Solar PV", "INV", 4, "solar"),
    ("battery", "storage", "Battery Storage", "BMS", 4, "battery"),
]
# Sensor specs: family, equipment, key, measurement, unit, alarm_low, alarm_high, min, max.
SPECS = [
    ("wind", "Gearbox", "GBX-OIL-T", "temperature", "degC", 15, 75, 10, 90),
    ("wind", "Generator", "GEN-BRG-T", "temperature", "degC", 15, 95, 10, 110),
    ("wind", "Generator", "PWR-ACT", "power", "kW", None, None, 0, 3300),
    ("wind", "Generator", "ROT-SPD", "speed", "rpm", 0, 20, 0, 22),
    ("wind", "Nacelle", "NAC-VIB", "vibration", "mm/s", None, 8, 0, 14),
    ("wind", "Nacelle", "WIND-SPD", "wind_speed", "m/s", None, 25, 0, 30),
    ("solar", "Inverter", "AC-PWR", "power", "kW", None, None, 0, 3600),
    ("solar", "Inverter", "DC-CURR", "current", "A", None, 1400, 0, 1500),
    ("solar", "Inverter", "INV-TEMP", "temperature", "degC", None, 75, 5, 90),
    ("solar", "ArrayMet", "POA-IRR", "irradiance", "W/m2", None, 1300, 0, 1300),
    ("battery", "PCS", "PWR", "power", "kW", None, None, -2500, 2500),
    ("battery", "BatterySystem", "SOC", "state_of_charge", "%", 10, 95, 5, 100),
    ("battery", "BatterySystem", "SOH", "state_of_health", "%", 70, None, 60, 100),
    ("battery", "BatterySystem", "CELL-TEMP", "temperature", "degC", None, 45, 5, 60),
]
GOOD_QUALITY = 192
BAD_QUALITY = (0, 64, 68)
# ---------------------------------------------------------------------------


def fleet_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    plants = spark.createDataFrame(PLANTS, "site_code string, site_name string, type string, country string")
    meta = spark.createDataFrame(TYPE_META, "type string, energy_source string, business_category string, "
                                            "unit_prefix string, num_units int, family string")
    specs = spark.createDataFrame(
        [(f, e, k, m, u, lo, hi, mn, mx) for f, e, k, m, u, lo, hi, mn, mx in SPECS],
        T.StructType([T.StructField("family", T.StringType()), T.StructField("equipment", T.StringType()),
                      T.StructField("key", T.StringType()), T.StructField("measurement_type", T.StringType()),
                      T.StructField("unit_of_measure", T.StringType()), T.StructField("alarm_low", T.IntegerType()),
                      T.StructField("alarm_high", T.IntegerType()), T.StructField("min", T.IntegerType()),
                      T.StructField("max", T.IntegerType())]))
    return plants, meta, specs


def fleet_dimension(spark: SparkSession, units: dict[str, int] | None = None) -> DataFrame:
    """One row per sensor with identity, site context and alarm bands (184 rows by default).

    ``units`` overrides the sampled units per plant type.
    """
    plants, meta, specs = fleet_tables(spark)
    if units:
        n = F.col("num_units")
        for t, k in units.items():
            n = F.when(F.col("type") == t, F.lit(k)).otherwise(n)
        meta = meta.withColumn("num_units", n)
    sites = plants.join(F.broadcast(meta), "type")
    out = expand_dimension(sites, specs, type_col="family")
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schemas.DIMENSION.fields])


def fleet_ranges(spark: SparkSession) -> DataFrame:
    """Physical range (min, max) per sensor key, for ``clip_to_range``."""
    _, _, specs = fleet_tables(spark)
    return specs.select("key", F.col("min").cast("double").alias("min"), F.col("max").cast("double").alias("max"))
