"""Business queries, derived operators, KPIs and the query registry."""
