"""slotwise: recommendation and campaign analytics as PySpark DataFrame operators.

``sources``    property bags, order import, scans, sinks
``functions``  Column helpers and skew-safe keyed building blocks
``operators``  the domain operators; DataFrames in, DataFrames out
``plans``      registered queries over the test tables, each with its SQL check
"""
