"""tillcast: sales x weather warehouse models as Spark DataFrame programs.

Every model is a plain function from DataFrames to a DataFrame. Instants are
``timestamp_ntz`` columns holding UTC, so no result depends on the session
time zone; local time always comes from the city's own zone.
"""
