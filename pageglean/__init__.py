"""Page keyword and audience-segment analytics on Spark."""
