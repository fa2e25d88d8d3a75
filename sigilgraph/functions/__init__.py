"""Scalar and array expressions: identity, clamps, time, tags, zones."""
