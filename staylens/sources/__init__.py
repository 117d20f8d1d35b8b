"""Reading raw files and tables, writing layers and reports."""
