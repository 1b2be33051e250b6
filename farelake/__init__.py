"""farelake: offer-price warehouse jobs written with PySpark DataFrames.

Layers (all DataFrame in, DataFrame out):

* ``sources``    document log, code lists, driver tables, fixture mappings
* ``functions``  column expressions (JSON fields, dates, buckets)
* ``operators``  staging, flattening, fact, marts, statistics, SCD2, checks
* ``plans``      materialisation, full-refresh composition, query registry
* ``streaming``  micro-batch ingest with Structured Streaming
"""

__version__ = "0.1.0"
