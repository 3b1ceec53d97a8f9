"""Composed plans: the trip dialects, SQL entry, written tables and the
registered queries over the driver's tables."""
