"""Corpus analytics on Spark: entities, texts, parse trees, key phrases, triples."""
