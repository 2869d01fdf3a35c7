"""Operators for large-scale training data. Optional: the core imports none."""
