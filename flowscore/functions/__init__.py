"""Column-level helpers: JSON codec, lenient casts, label and name mapping.

All of them return Spark Column expressions or plain projections, so they
stay inside whole-stage code generation.
"""
