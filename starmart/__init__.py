"""Star-schema, SCD2, data-quality and feature tables on Spark DataFrames."""

__version__ = "0.1.0"
