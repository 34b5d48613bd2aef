"""Market-trade tick analytics as plain DataFrame-to-DataFrame functions on Spark."""
