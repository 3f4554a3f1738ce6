"""Column expressions: parsing, predicates and projections (all JVM-side)."""
