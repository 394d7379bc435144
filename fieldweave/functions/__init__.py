"""Column functions for geometry and time."""
