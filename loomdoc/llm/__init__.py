"""Operators for training-data pipelines; nothing else in loomdoc imports this subpackage."""
