"""strata: layered batch analytics (raw -> staging -> mart) on Spark DataFrames."""

__version__ = "0.1.0"
