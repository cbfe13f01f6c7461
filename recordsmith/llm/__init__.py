"""Training-data operators (tokenising, dedup, cleaning, scoring) on Spark."""
