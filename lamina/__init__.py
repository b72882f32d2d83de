"""lamina: a layered (raw, bronze, silver, gold) analytics engine on Spark DataFrames."""
