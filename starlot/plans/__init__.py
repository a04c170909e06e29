"""Dimension and fact builders, KPIs, quality report and the full refresh."""
