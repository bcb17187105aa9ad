"""Operators of a training-data pipeline: scans, de-duplication, packing, decontamination.

Nothing else in the library imports this subpackage.
"""
