"""snapmart — snapshot-to-mart analytics expressed as Spark DataFrame plans.

Layers (each a set of ``DataFrame -> DataFrame`` functions):

* ``sources``    landing envelopes, landing keys, JSON scans, raw tables, category maps
* ``functions``  column-level helpers (typed variant access, NULL ordering, time formats)
* ``operators``  snapshot cut, flatten, dedup, rollups, joins, merge, load planning, checks
* ``plans``      the staging models, marts and KPIs composed from the operators
* ``streaming``  the file-source incremental load
"""

__version__ = "0.1.0"
