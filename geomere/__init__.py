"""Geospatial analytics on Spark: geography columns, ``st_*`` functions and spatial joins."""
