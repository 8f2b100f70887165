"""The exports' relational work: functions from DataFrames to DataFrames."""
