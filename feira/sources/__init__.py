"""Reading raw files and reading or writing table layers."""
