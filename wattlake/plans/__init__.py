"""Layer jobs and the SQL surface."""
