"""Operators for preparing large text corpora for model training.

Nothing outside this package imports it; ``queries`` registers one query per
operator with the driver's entry file.
"""
