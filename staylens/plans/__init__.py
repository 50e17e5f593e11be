"""Query plans: fixture relations, the registered queries, oracle SQL and the batch job."""
