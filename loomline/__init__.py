"""Loomline: a PySpark engine that curates chat corpora for fine-tuning."""
