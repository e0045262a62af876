"""End-to-end plans: bronze, silver, gold."""
