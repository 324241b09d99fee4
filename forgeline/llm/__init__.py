"""Operators for large-scale training-data pipelines.

One module per operator; ``queries`` holds the thin registered queries and
their SQL.  Nothing else in the library imports this subpackage."""
