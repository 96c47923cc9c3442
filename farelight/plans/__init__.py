"""Batch jobs composed of operators; each module runs with ``python -m``."""
