"""Event time and watermarks, starting and finishing streams, progress listeners."""
