"""curata: data-quality and binary-classification operators on Spark DataFrames.

Every operator takes a DataFrame and returns a DataFrame (or a fitted MLlib
model).  Row data stays on the executors; only bounded aggregates (a handful
of numbers per column) ever reach the driver.
"""

from curata.spec import EncounterSpec, DEFAULT_SPEC

__all__ = ["EncounterSpec", "DEFAULT_SPEC"]
