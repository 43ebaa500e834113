"""The job's logical plans: cleaning, scoring, read models and analytical queries."""
