"""Sources and sinks: typed CSV ingest with rejects, partitioned writes and
snapshot tables with history."""
