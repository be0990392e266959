"""Column builders: text, contract rules, vectors."""
