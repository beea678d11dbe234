"""Sinks for key-value stores."""
