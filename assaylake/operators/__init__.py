"""Operators over verdicts, logs and metadata tables."""
