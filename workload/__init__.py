"""The given tables bound to the warehouse: inputs, registered queries, oracle SQL."""
