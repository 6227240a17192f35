"""metrolens: city-sensor batch analytics expressed as Spark DataFrame plans.

Sub-packages:
  functions  column expressions (geo distance, time parsing, exact rounding, labels)
  sources    inputs: fixture views over the test tables, readers, table maintenance
  operators  composite DataFrame operators (clean, nearest stop, timetable match, ...)
  plans      the registered query catalog and its DuckDB oracle SQL
  streaming  incremental (micro-batch) driver for the hourly clean job
"""

__version__ = "0.1.0"
