"""Settlement reconciliation as Spark DataFrame transformations."""
