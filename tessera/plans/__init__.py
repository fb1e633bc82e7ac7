"""Composed plans: the export-shaped frame, the reduced table and the registered queries."""
