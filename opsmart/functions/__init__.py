"""Column expressions. No function here triggers a shuffle or a job."""
