"""wellspring: household water-survey analytics as Spark DataFrame operators.

Entry points: ``plans.build.build_full`` (first run), ``plans.increment.run_increment``
(incremental run over a ``operators.incremental.TableStore``), ``plans.monitors``,
``plans.checks`` with ``operators.expectations.run_expectations``, and
``streaming.ingest`` for the Structured Streaming paths.
"""

__version__ = "0.1.0"
