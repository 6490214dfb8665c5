"""eventsieve: event quality and inventory analytics as Spark DataFrame jobs.

Modules: ``schemas``, ``session``, ``functions`` (rule columns), ``sources`` (readers and
fixtures), ``operators`` (quality, keys, summary, ledger, recovery, checks), ``streaming``
(ingest, sinks, windows, replay) and ``plans`` (registered queries, oracle SQL, jobs, CLI).
"""

__version__ = "0.1.0"
