"""Reading and writing: JSON readings, the raw and processed lake, the star tables, optional JDBC."""
