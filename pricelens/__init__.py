"""pricelens: in-network rate files flattened, laid out and checked with Spark DataFrames."""

__version__ = "0.1.0"
