"""Pipelines (bronze -> silver -> gold runs) and the registered query catalogue."""
