"""scorelab: questionnaire analytics on Spark DataFrames.

Every operator takes and returns DataFrames (or Columns), so that whole
reports stay one lazy plan until the caller writes or shows them.
"""
