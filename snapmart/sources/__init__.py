"""Landing zone, JSON scans, raw tables and table versions."""
