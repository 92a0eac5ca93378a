"""Native column functions: no Python UDFs here."""
