"""Live match-event analytics on Spark."""
