"""Composite plans: clean facts (facts), growth reports (reports), the whole job
(job), and the registered queries with their oracle SQL (catalog, oracle)."""
