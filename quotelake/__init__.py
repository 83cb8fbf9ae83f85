"""Market-data analytics as PySpark DataFrame jobs.

Every public function takes and returns DataFrames (or Columns). Clock values
such as ``as_of`` and ``batch_ts`` are arguments, so a job gives the same rows
whenever it is run again.
"""
