"""Training-data operators: packing, near duplicates, mixing, quality,
toxicity, language models and chat formatting. Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it."""
