"""Scans and sinks: archives, hourly slots, reference data, profiles."""
