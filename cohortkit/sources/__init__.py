"""Sources and sinks: JSON documents, landing folder, Parquet."""
