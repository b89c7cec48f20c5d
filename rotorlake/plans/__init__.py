"""The daily jobs, composed of operators."""
