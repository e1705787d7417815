"""holdrift: follow what portfolios hold over time, as Spark DataFrame operators."""
