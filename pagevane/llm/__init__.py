"""Operators for training data; see the README's section on them."""
