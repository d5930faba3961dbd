"""fleetmart: fleet and fuel-efficiency analytics as plain functions over Spark DataFrames and Columns."""

__version__ = "0.1.0"
