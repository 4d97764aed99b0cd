"""Sources and sinks: driver-table adapters, JSON payload scans, CSV/table/JDBC I/O."""
