"""Operators for training-data pipelines on whole corpora. Nothing else in the library imports them."""
