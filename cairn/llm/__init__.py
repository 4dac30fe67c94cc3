"""Training-data operators: packing, WARC, quality, URL filters, near
duplicates, exact search, chat formatting, BPE and toxicity.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
