"""Compiles text corpora into validated, retrieval-ready knowledge packs on Spark."""
