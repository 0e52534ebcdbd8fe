"""Relational operators of the snapshot-to-mart flow, each ``DataFrame -> DataFrame``."""
