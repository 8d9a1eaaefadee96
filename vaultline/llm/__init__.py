"""Training-data operators: filters, dedup, scoring, decontamination, mixing.

Nothing outside this subpackage imports it, apart from the guarded
registration in ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
