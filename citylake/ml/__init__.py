"""Congestion-level models on MLlib."""
