"""Runs put together from operators: k-fold, sweep, records, unified metrics."""
