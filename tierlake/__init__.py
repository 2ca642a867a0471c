"""tierlake: layered (bronze, silver, gold) analytics written as plain Spark jobs."""
