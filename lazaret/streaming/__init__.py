"""The two coupled streams: validate, and repair and retry."""
