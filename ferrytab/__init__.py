"""Move tables between systems with Spark and prove that nothing was lost on the way."""
