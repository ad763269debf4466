"""Operators of a training-data pipeline over text, conversation and vector tables."""
