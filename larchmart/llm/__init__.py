"""Operators for preparing large-scale training corpora, and their queries.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries when it is present.
"""
