"""Operators of a large training-data pipeline over ``documents`` and ``embeddings``.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries when it can be imported.
"""
