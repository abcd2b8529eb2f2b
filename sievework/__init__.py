"""Curation of language-model training data on Spark: lazy DataFrame operators over samples, code symbols and documents."""

__version__ = "0.1.0"
