"""Operators for preparing training data: each stands alone; ``queries`` registers them."""
