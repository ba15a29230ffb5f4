"""Plans: the operators put together over the given tables and over brokerage feeds derived from them."""
