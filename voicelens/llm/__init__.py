"""Training-data operators: dedup, quality, URL, secret, HTML, tokens, packing, sharding.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
