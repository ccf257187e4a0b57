"""The reports, one function per result table."""
