"""DataFrame operators: profiling, cleaning, features, rebalancing, evaluation, explanation."""
