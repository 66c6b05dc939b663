"""Training-data operators: scoring, packing, deduplication and filtering of documents.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
