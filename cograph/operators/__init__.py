"""DataFrame operators: graph building (G*), neighbour ranking (N*), user
recommendations (V*), detailed variants, event preparation (P*, X1-X4),
inspection helpers (X5-X9) and statistics (A13)."""
