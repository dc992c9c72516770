"""Report plans (ratings, reviews), the registered queries (catalog), oracle SQL and jobs."""
