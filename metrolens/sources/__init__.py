"""Inputs: fixture views over the test tables, readers, and table maintenance."""
