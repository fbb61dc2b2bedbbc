"""The whole curation flow, and the queries registered for checking."""
