"""Reading and writing the tables."""
