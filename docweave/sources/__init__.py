"""Sources and scans."""
