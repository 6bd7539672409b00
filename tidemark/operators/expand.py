"""Dimension expansion, plants × units × sensor specs → one row per sensor.

The expansion is a join of plants to their type's metadata and specs plus an
``explode(sequence(1, num_units))``; ids and tags are composed with
``format_string``.  It runs on the executors, no driver-side loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import compose_id, compose_tag


def expand_units(plants: DataFrame, units: str = "num_units") -> DataFrame:
    """One row per (plant, unit number) for unit numbers 1..num_units."""
    return plants.withColumn("unit", F.explode(F.sequence(F.lit(1), F.col(units))))


def expand_dimension(plants: DataFrame, specs: DataFrame, type_col: str = "type",
                     site: str = "site_code", prefix: str = "unit_prefix",
                     units: str = "num_units") -> DataFrame:
    """Plants (site, type, prefix, num_units, ...) ⋈ specs (type, key, ...) → sensors.

    Adds ``unit_id``, ``sensor_asset_id`` and ``scada_tag``; band columns are
    cast to double (nulls kept).
    """
    rows = expand_units(plants, units).join(specs, type_col)
    out = (rows
           .withColumn("unit_id", F.format_string("%s-%s%02d", F.col(site), F.col(prefix), F.col("unit")))
           .withColumn("sensor_asset_id", compose_id(site, prefix, "unit", "key"))
           .withColumn("scada_tag", compose_tag(site, prefix, "unit", "key",
                                                "signal" if "signal" in specs.columns else None)))
    for band in ("alarm_low", "alarm_high"):
        if band in out.columns:
            out = out.withColumn(band, F.col(band).cast("double"))
    return out
