"""Views, reports and the query workload."""
