"""strata: a layered (bronze / silver / gold) listing-analytics library on Spark DataFrames.

Every operator is a function from DataFrame(s) to a lazy DataFrame built from Spark's own
expressions, joins, windows and aggregates. Nothing is collected to the driver.
"""

from strata.session import configure, workspace

__all__ = ["configure", "workspace"]
