"""valuemark: provider-value analytics and corpus operators on Spark."""
