"""evidentia: evidence-first record linkage and reconciliation on PySpark."""
