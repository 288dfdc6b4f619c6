"""chorus: opinion analytics as PySpark DataFrame operators.

Every public function takes and returns DataFrames (or Columns), takes
column names, keywords and thresholds as parameters, and performs no
action except where writing is the point (sinks, round trips).
"""

__version__ = "0.1.0"
