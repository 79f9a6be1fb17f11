"""Data products composed from operators."""
