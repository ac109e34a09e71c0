"""Composed plans: bindings to the driver tables, reports, the pipeline."""
