"""monthwise: monthly service-record reporting on Spark.

Layers:

* ``sources``   – input schemas, table readers and the test-fixture projection.
* ``functions`` – column-level building blocks (labels, recodes, bands, flags, dates).
* ``operators`` – DataFrame -> DataFrame operators (periods, latest submission,
  ranking, lookups, pairing, contact counting, roll-ups, publishing).
* ``plans``     – the ten publishing pipelines composed from the operators.
* ``streaming`` – a monthly refresh driven by newly landed submissions.
"""

from monthwise.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
