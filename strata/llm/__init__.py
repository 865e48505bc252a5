"""Operators for preparing large text corpora (see README, "Training-data operators").

Nothing outside this package imports it.
"""
