"""Shipment-delay analytics on Spark DataFrames.

``sources`` reads and writes tables, ``functions`` holds column expressions,
``operators`` holds DataFrame-to-DataFrame operators and fitted models, and
``plans`` composes them into jobs.
"""

__version__ = "0.1.0"
