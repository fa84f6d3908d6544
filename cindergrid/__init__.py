"""Carbon-emission and grid-intensity analytics as plain PySpark DataFrame functions."""
