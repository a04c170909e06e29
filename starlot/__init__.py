"""Temporal star-schema toolkit for PySpark.

Functions take and return DataFrames (or Columns).  They are lazy but for size
checks of lookup sides and histories, written members and moments, and the refresh.
"""

__version__ = "0.1.0"
