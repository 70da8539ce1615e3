"""Scalar column expressions (built-in Catalyst functions only) and the fixed
values that must match the reference: id format, direction labels, time
formats, missing-value tokens."""
