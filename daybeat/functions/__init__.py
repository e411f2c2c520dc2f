"""Building blocks the operators share: exact quantiles, ordered fills, formatting."""
