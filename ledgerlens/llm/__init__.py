"""Training-data operators (numbered 1 to 10) and the queries that apply them.

Nothing outside this folder imports it except the guard in ``__spark_entry__`` and
``corpus_pipeline``; removing the folder leaves the rest of the library working.
"""
