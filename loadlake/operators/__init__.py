"""Reusable DataFrame operators: grids, time blocks, windows, as-of joins, quantiles, checks."""
