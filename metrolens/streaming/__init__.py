"""Incremental drivers. The analyses are batch jobs run per date/hour; here the hourly
clean job runs as a Structured Streaming query so each new raw partition is cleaned
and merged once, with progress kept in the shared checkpoint folder."""
