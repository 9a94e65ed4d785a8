"""veritab: tabular-ML and recommendation analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame(s) -> DataFrame`` whose work runs in
executors; only scalars (fitted statistics, chosen thresholds, tuned weights)
ever reach the driver.
"""

__version__ = "0.1.0"
