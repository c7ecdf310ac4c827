"""Occupancy analytics for visit data, written as Spark DataFrame functions."""

from dwellgrid.settings import Settings

__all__ = ["Settings"]
