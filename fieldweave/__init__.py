"""A PySpark-native analytics engine for gridded, ensemble and track-shaped data."""
