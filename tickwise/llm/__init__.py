"""Training-data operators: page text, packing, chat, privacy, secrets,
licences, quality, decontamination, near copies and token counts.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
