"""Rule-based fraud analytics on wallet and cash-agent payment feeds, as Spark jobs."""
