"""Training-data operators: corpus operators, their queries and their DuckDB SQL.

Nothing outside this package (and ``corpus_pipeline.py`` at the top) imports it.
"""
