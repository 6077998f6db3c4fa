"""Sinks: catalog tables, JDBC, and the run state."""
