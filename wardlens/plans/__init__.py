"""Registered queries: each runs operators on the star-schema tables and carries
the SQL another engine can run to check it."""
