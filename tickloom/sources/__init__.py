"""Scans, sinks, the feature catalog, and bars derived from the driver's tables."""
