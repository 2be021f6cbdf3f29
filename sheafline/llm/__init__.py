"""Training-data operators: cleaning, deduplication, decontamination and tokenisation of text corpora.

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` at the repository top chains five of its operators.
"""
