"""Operators of a training-data pipeline, each built by the method named for it.

Nothing else in the library imports this subpackage; it uses the library's
general helpers (session, shared scratch folder).  ``queries`` registers one
query per operator, ``corpus_pipeline.py`` at the repository top chains five
of them.
"""
