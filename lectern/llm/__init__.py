"""Training-data operators: ten components over the ``documents`` and ``embeddings`` tables.

Nothing outside this package imports it; :mod:`lectern.llm.registry` lists its queries.
"""
