"""Dayfolio: daily, per-category document evaluation on PySpark DataFrames."""
