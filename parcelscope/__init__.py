"""Parcel-shipment sales reviews as lazy PySpark DataFrame programs."""

from parcelscope.params import ReviewParams
from parcelscope.sources.tables import ShipmentTables

__all__ = ["ReviewParams", "ShipmentTables"]
