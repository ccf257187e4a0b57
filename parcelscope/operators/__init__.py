"""Frame-to-frame building blocks shared by the reports."""
