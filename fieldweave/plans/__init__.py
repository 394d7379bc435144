"""Campaign planning and the catalogue of queries."""
