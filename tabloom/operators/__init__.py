"""DataFrame operators, by kind."""
