"""farebox: taxi-trip analytics as Spark jobs.

Modules: ``sources`` / ``sinks`` (I/O), ``functions.columns`` (Column helpers),
``operators`` (filters, joins, aggregates, windows, top-k, quality checks),
``plans`` (warehouse models, idempotent loads), ``streaming`` (event-time jobs),
``session`` (session defaults, shared checkpoint folder, partition sizing).
"""

__version__ = "0.1.0"
