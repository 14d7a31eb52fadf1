"""Training, validation, scoring and explanation of forests."""
