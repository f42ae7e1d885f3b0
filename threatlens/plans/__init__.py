"""Named queries: the serving tables, the country study and the registered checks."""
