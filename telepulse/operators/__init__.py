"""Operators on telemetry, metrics and alarms."""
