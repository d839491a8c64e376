"""Daily-signal analytics as PySpark DataFrame operators.

Every operator takes and returns DataFrames and works on a panel: ``keys`` names
the columns that identify a series, so one plan serves one asset or a million.
"""

__version__ = "0.1.0"
