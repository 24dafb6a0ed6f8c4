"""Operators of large training-data pipelines: shards, near copies, classifiers, tokens."""
