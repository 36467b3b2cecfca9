"""Readers of telemetry documents, listings and log files."""
