"""bidlake: bid-tabulation analytics as Spark DataFrame functions."""
