"""Training-data operators: packing, mixing, filtering and de-duplication of document corpora.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it; it can be removed as a whole.
"""
