"""staylens — rental-market analytics as lazy Spark DataFrame operators.

Every public operator is a function ``DataFrame(s) + column names -> DataFrame``.
Nothing is collected on the driver except bounded, per-group statistics
(a handful of numbers per test or per model).
"""

__version__ = "0.1.0"
