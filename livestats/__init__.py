"""livestats: live-commerce analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function built from Catalyst
expressions.  Batch forms run on whole tables; the ``streaming`` package holds
the Structured Streaming forms (watermarks, state, ``foreachBatch``).
"""

__version__ = "0.1.0"
