"""stocktide: retail and telemetry lakehouse analytics as plain Spark jobs.

Every operator takes DataFrames (or Columns) and returns DataFrames, so Catalyst
sees one declarative plan; the functions marked "stream-safe" in their module also
accept a streaming DataFrame.
"""

__version__ = "0.1.0"
