"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

Nothing else in the library imports this subpackage.  Every operator is a
function from DataFrames to a DataFrame; ``queries.py`` applies each of them
to its whole table and ``corpus_pipeline.py`` (top of the repository) chains
five of them.
"""
