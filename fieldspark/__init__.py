"""Spark-native analytics for ecological field surveys and ocean-temperature grids.

``functions``  Column -> Column helpers (null semantics, text, dates, models)
``operators``  DataFrame -> DataFrame building blocks (joins, as-of, aggregates, statistics)
``sources``    landed tables, typing, sinks and snapshots
``plans``      the survey jobs composed from the above
``streaming``  the row-wise form plans over a streaming source
"""
