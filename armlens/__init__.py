"""armlens: A/B price-experiment analytics as Spark DataFrame jobs.

Layers
------
functions/  column-level building blocks (SQL-dialect compat, strings, geo)
operators/  the experiment operators (dimensions, orders, sessions, inference)
sources/    readers for the driver tables, adapters onto the experiment schemas, sinks
plans/      DAG composition of the whole pipeline, the query registry, size guards
llm/        corpus operators for training data (optional; nothing else imports it)

Operators take and return DataFrames. Small lookup tables are written to the
checkpoint folder while a plan is built, so building some plans runs jobs.
"""

__version__ = "0.1.0"
