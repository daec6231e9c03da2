"""Table-level plans: silver and gold tables, sentiment scoring, consumer queries, layer runs."""
