"""Raster x polygon x time analytics on PySpark DataFrames."""
