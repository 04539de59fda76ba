"""Readers of the monitoring relations, the test-table mapping and sinks."""
