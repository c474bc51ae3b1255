"""Operators of a training-data pipeline: chat formatting, quality rules, line
dedup, source mixing, secret scans, substring dedup, BPE, nearest neighbours,
SimHash near-dedup and license scans. Nothing outside this package imports it.
"""
