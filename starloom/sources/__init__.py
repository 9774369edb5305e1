"""Reading landed files and tables, writing results."""
