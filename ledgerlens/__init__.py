"""ledgerlens: branch and AML regulatory reporting on Spark DataFrames.

Every report and check is a plain ``DataFrame -> DataFrame`` function built
from Spark's DataFrame/SQL API, so Catalyst and AQE plan the work.

Layout
------
``sources``    readers (driver test tables, JDBC, catalog) and table sinks
``functions``  column expressions and rule predicates
``operators``  reports, de-duplication, quality and migration operators
``plans``      end-to-end jobs, the query registry and its DuckDB oracle
"""

from ledgerlens.session import get_spark_session, checkpoint_dir

__all__ = ["get_spark_session", "checkpoint_dir"]
