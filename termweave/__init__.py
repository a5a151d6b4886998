"""Student-record reconciliation on Spark.

Every public function takes and returns DataFrames or Columns; nothing here runs an action
except the sinks and the streaming runner.
"""
