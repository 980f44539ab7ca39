"""Feature tables and event-window analytics on Spark DataFrames."""
