"""cohortwise: cohort pathway analytics as Spark DataFrame jobs.

The layers build on each other:

* ``functions``  column expressions (dates, cleaning, text)
* ``operators``  DataFrame to DataFrame building blocks (selection, joins, aggregates, reshaping)
* ``plans``      cleaned tables, metrics, reports, pathway evaluation and models
* ``sources``    readers, writers and the test views over the driver's tables
* ``checks``     the registered queries and their SQL twins
"""
