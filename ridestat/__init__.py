"""ridestat: shared-mobility trip analytics on Spark DataFrames.

Layers:

* ``functions``  column-expression rules (station keys, gender, age, datetimes, calendar)
* ``sources``    CSV header audit and header-group reads, GBFS JSON, station CSV, stored tables,
                 and the driver-table trip proxy used by the registered queries
* ``operators``  DataFrame -> DataFrame steps: cleaning, row index, quality, validation,
                 triage, dashboard reports
* ``plans``      views, the load / export pipeline and the query registry
* ``sinks``      CSV / Parquet writers
* ``llm``        training-data operators (optional; nothing else imports it)
"""

__version__ = "0.1.0"
