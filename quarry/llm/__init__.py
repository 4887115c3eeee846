"""Operators of a training-data pipeline: mixing, dedup, scoring, packing, search, scans, chat bytes.

Nothing else in the library imports this subpackage.  ``queries`` registers
one query per operator; ``corpus_pipeline.py`` at the repository top chains
five of them.
"""
