"""Sales and workforce analytics on Spark DataFrames."""

from grainline import functions, operators, plans, sources

__all__ = ["functions", "operators", "plans", "sources"]
