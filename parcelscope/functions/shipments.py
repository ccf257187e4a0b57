"""Attributes derived from one shipment row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parcelscope.schema import ZONE_SLOTS

# The zone code behind each per-zone column suffix.
SLOT_ZONES = {"za": "A", "zb": "B", "zc": "C"}


def zone_type() -> Column:
    """`WC` within one city, else the destination zone."""
    return F.when(F.col("origin").eqNullSafe(F.col("dest")), "WC").otherwise(F.col("dest_zone"))


def zone_slot() -> Column:
    """Suffix of the per-zone column a shipment counts in; null outside all four."""
    away = F.col("origin") != F.col("dest")
    slot = F.when(F.col("origin") == F.col("dest"), ZONE_SLOTS[0])
    for suffix, zone in SLOT_ZONES.items():
        slot = slot.when(away & (F.col("dest_zone") == zone), suffix)
    return slot


def weight_class() -> Column:
    return (
        F.when(F.col("weight") <= 0.5, "0-0.5").when(F.col("weight") <= 1.0, "0.5-1.0").otherwise("1+")
    )


def left_closed_band(value: Column, edges: tuple[int, ...]) -> Column:
    """Position of the band [edge, next edge) holding `value`; null outside all bands."""
    bands = F.lit(None).cast("int")
    for position in range(len(edges) - 1, 0, -1):
        inside = (value >= edges[position - 1]) & (value < edges[position])
        bands = F.when(inside, F.lit(position)).otherwise(bands)
    return bands
