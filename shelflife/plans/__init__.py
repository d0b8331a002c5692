"""Jobs that chain the operators and write their tables."""
