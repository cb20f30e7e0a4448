"""tagloom: rule-driven user tagging on Spark DataFrames.

Every public function takes DataFrames (or Columns) and returns DataFrames (or Columns); the caller
owns the SparkSession. See README.md for the map from task to function.
"""
