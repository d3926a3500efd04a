"""loadshift: baseline-vs-upgrade load analytics as lazy Spark DataFrame operators.

Sub-packages:
  functions  Column builders (missing-value rules, units, hour-ending time, name selectors)
  sources    readers and writers (CSV, parquet series datasets) and the driver-table views
  operators  DataFrame -> DataFrame domain operators (sampling, roll-ups, arm comparison, reports)
  plans      end-to-end jobs and the registered queries with their SQL oracles
  streaming  the hourly portfolio roll-up as a Structured Streaming query
"""

__version__ = "0.1.0"
