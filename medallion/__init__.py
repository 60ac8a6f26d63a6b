"""medallion — tiered (bronze → silver → gold) table work on PySpark.

Every public operator is a plain function over ``DataFrame`` / ``Column``;
Catalyst plans the whole chain.  Sub-packages:

* ``functions``  Column → Column expressions (rounding, bands, keys, URLs, dates)
* ``operators``  DataFrame → DataFrame operators (silver, gold, marts, reshaping,
  set operations, series, catalog helpers, upsert) and ``operators.checks``
* ``sources``    CSV ingest, partitioned writes, snapshot tables with history
* ``plans``      scale-oriented plan shapes (range-bucketed global windows,
  histogram percent rank) and plan-inspection helpers
* ``streaming``  incremental file ingest with Structured Streaming
* ``bindings``   binding of the operators to the driver's test tables
"""

__version__ = "0.1.0"
