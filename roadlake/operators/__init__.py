"""DataFrame operators on events."""
