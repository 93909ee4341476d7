"""Sources and sinks: JSON event logs, delimited stage files, Parquet stage
tables, keyed serving tables, and views over the supplied test tables."""
