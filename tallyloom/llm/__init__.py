"""Operators for training-data pipelines on texts and records; nothing outside this folder imports them."""
