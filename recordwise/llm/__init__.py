"""Operators for preparing training data at scale; see ``queries`` for the registered ones."""
