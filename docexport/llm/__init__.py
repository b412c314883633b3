"""Operators for large training-text pipelines, one module per operator.

Nothing else in the package imports this subpackage. Every operator selects
only the columns it needs, so further columns of any name are harmless.
"""
