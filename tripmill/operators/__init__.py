"""Operators on trip frames: cleaning, audits, numbering, latest row per key."""
