"""Composite DataFrame operators. Every operator takes and returns DataFrames and
never collects rows to the driver."""
