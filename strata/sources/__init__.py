"""Readers, sinks and the test-data adapters."""
