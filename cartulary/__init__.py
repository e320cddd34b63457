"""cartulary: a PySpark library for building and querying a statistics archive.

Every public function takes and returns DataFrames (or Columns), so the caller
keeps composing and Catalyst sees one plan.
"""
