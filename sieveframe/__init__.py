"""Checked, summarised and publishable tables on Spark."""
