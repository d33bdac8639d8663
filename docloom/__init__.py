"""docloom: document knowledge engine on PySpark DataFrames.

Documents are extracted, cleaned, cut into sentence-aligned chunks, encoded to
unit vectors and searched exactly.  Everything is a lazily composed DataFrame or
Column; Python workers are used only where Spark has no expression.
"""
