"""Relational operators the models are made of."""
