"""Domain-shaped inputs derived from the driver's tables, and the queries compared with SQL."""
