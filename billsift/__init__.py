"""billsift: invoice field extraction, loading and spending analytics on Spark."""
