"""Query registry: callables over a session and a data folder, with their SQL."""
