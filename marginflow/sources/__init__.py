"""Sources and sinks: explicit schemas, the test-data adapter, CSV/Parquet I/O."""
