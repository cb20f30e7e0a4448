"""The monthly jobs, composed from the operators."""
