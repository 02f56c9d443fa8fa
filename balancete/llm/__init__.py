"""Operators of a training-data pipeline over ``documents`` (see README, "llm")."""
