"""ratelens: ratings and reviews analytics as Spark DataFrame plans.

Subpackages: ``sources`` (readers, driver-table entities), ``functions``
(column expressions), ``operators`` (lookup, aggregates, top-k, explode),
``plans`` (reports, registered queries, oracle SQL, jobs), ``sinks``
(writers, staging) and ``streaming`` (incremental means).
"""

__version__ = "0.1.0"
