"""Question-and-answer post analytics on Spark.

Every public function takes and returns DataFrames or Columns, and none holds
a session of its own: the caller's SparkSession decides where the work runs.
"""
