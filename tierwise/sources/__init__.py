"""Readers: delimited and JSON files (``files``), catalog and connector tables (``tables``)."""
