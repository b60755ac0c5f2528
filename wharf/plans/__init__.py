"""Plan shapes reused by the operators: size-checked joins and running aggregates."""
