"""Clinical-surveillance analytics as Spark DataFrame functions."""
