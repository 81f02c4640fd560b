"""Sales analytics as Spark plans: queries, reports, row changes, audit and checks."""
