"""Independent SQL for the checking engine."""
