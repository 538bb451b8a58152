"""Table, CSV and multi-file scans."""
