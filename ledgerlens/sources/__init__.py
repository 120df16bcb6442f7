"""Readers and sinks: driver test tables, JDBC, catalog tables."""
