"""Composite plans: the fraud report, the accumulating mart, the daily run."""
