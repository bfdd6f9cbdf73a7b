"""Composed analyses, the views they read in the driver tables, and the query catalogue."""
