"""Operators a training-data pipeline needs."""
