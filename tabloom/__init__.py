"""tabloom: tabular analytics and feature preparation on Spark DataFrames."""
