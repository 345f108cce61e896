"""Operators for training data; each module is one operator and imports only what it needs."""
