"""Operators that prepare text corpora for model training.

One module per operator; ``queries`` registers them over the given tables.
Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
