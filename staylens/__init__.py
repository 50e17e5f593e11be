"""staylens: stay-interval (length-of-stay) analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL expressions,
windows, joins and aggregates, so Catalyst and AQE plan the work.

Entry points:

* ``staylens.sources.tables.load_admissions / load_patients`` – read CSV, gz CSV or Parquet.
* ``staylens.operators.cohort.build_inpatient_cohort`` – the cohort (``mode="sql"`` or ``"python"``).
* ``staylens.operators.profile``, ``labels``, ``quality``, ``outliers`` – reports.
* ``staylens.operators.ml`` and ``evaluate`` – training, evaluation and threshold policy.
* ``staylens.operators.score`` and ``staylens.streaming.scoring`` – batch and stream scoring.
* ``staylens.plans.batch`` – the end-to-end job; ``staylens.plans.views`` – SQL temp views.
* ``staylens.operators.ordered`` – exact ranks, percentiles and running sums at scale.
"""

__version__ = "0.1.0"
