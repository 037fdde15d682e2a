"""Functions from DataFrames to DataFrames; none of them starts a job unless its text says so."""
