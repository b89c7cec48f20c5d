"""Views over the driver tables, the registered queries and their SQL twins."""
