"""Sources and sinks: the canonical Parquet log, the newline-JSON wire log."""
