"""Reading tables, writing results, and durable intermediate tables."""
