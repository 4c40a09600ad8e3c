"""Messy spreadsheet-like files to clean, typed tables, on Spark."""
