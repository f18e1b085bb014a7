"""Readers, writers, the preprocessing cache and the metric log."""
