"""DataFrame operators, from reads to annotated clusters."""
