"""Tables and logs: reading, writing, request intake, run metrics, models."""
