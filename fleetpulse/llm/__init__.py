"""Training-data operators: ten corpus operators and their registered queries.

Nothing outside this subpackage imports it, except ``__spark_entry__.py``
(guarded) and ``corpus_pipeline.py``.
"""
