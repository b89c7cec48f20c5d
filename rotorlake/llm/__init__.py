"""Operators for large text corpora that feed model training; nothing outside this subpackage imports it."""
