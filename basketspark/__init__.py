"""basketspark: co-view recommendations ("customers who viewed X also viewed Y") as Spark plans.

Every step is a function from DataFrames to DataFrames:

* ``sources``    - readers bound by column name, and the test-data views.
* ``functions``  - column expressions shared by several steps.
* ``operators``  - clicks, sales, affinity (pair matrix), recommend, indexing,
                   significance, quality, publish.
* ``plans``      - the end-to-end job and the registry of named queries.
* ``streaming``  - the click-cleaning step as a Structured Streaming query.
"""

from basketspark.config import RunConfig, date_window

__all__ = ["RunConfig", "date_window"]
