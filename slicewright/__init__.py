"""Slicewright: metadata-driven batch integration as plain Spark DataFrame plans.

Every operator takes DataFrames and returns DataFrames.  Clocks, run ids and
business dates are arguments; errors are data (status columns), with
``raise_on_failures`` for callers who want an exception instead.
"""

__version__ = "0.1.0"
