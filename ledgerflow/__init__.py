"""ledgerflow: personal and multi-account finance analytics as Spark jobs.

Every operator is a function from DataFrames to a DataFrame.  Operators that
order or carry values over time take ``keys`` (owner / account columns); an
empty list reproduces a single-owner book, a non-empty one partitions every
window and join so the same code scales to many owners.
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
