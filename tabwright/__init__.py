"""tabwright: tabular feature preparation, model comparison and drift checks as Spark jobs.

Every step is a ``DataFrame -> DataFrame`` function (or a ``fit_*`` returning a small frozen
parameter record plus an ``apply_*`` that turns it into column expressions).  Nothing here
collects a table to the driver: fitted statistics are one-row aggregates, category lists are
size-checked, and everything else stays a lazy Spark plan.
"""

__version__ = "0.1.0"
