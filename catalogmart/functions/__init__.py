"""Column expressions: business rules, text/JSON predicates, exact means."""
