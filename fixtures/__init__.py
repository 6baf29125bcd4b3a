"""The library over the driver's test tables: adapters, registered queries, DuckDB equivalents."""
