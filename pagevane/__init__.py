"""Pagevane: crawled web pages to a searchable vector index, as Spark jobs.

Sub-packages
------------
``functions``  Column -> Column expressions (HTML, language, segmentation, vectors).
``operators``  DataFrame -> DataFrame operators, usable with ``df.transform``.
``sources``    manifest, archive and message readers.
``sinks``      index, message and metric tables.
``plans``      whole batch jobs and the registered queries.
``streaming``  the same stages as Structured Streaming jobs.
"""

__version__ = "0.1.0"
