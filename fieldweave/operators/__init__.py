"""Operators on fields, graphs, meshes, positions on the sphere, cyclone tracks and whole trackers."""
