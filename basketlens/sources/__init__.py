"""Reading and writing the retail tables."""
