"""Column functions: comma-separated text, templates and month arithmetic."""
