"""Job-market analytics as plain DataFrame functions on Spark."""
