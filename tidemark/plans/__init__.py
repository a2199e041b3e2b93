"""Query plans: test-data views, report families and the oracle SQL."""
