"""Column expressions and table functions shared by queries and views."""
