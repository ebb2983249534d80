"""salesmart: sales and HR KPI marts as Spark DataFrame jobs.

Layout
  sources/    readers for the staging relations and the fixture adapter
  functions/  Column expressions for the derived measures (tenure, age, labels)
  operators/  reusable DataFrame operators (upsert, first-row flags, bucket counts)
  plans/      the marts, one pure DataFrame -> DataFrame function each
  streaming/  incremental refresh with Structured Streaming
"""

from salesmart.rules import Rules, DEFAULT_RULES

__all__ = ["Rules", "DEFAULT_RULES"]
