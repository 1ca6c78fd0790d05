"""File-arrival streams: each new upload is processed as it lands."""
