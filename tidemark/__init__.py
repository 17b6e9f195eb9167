"""Detection correlation and label engine on Spark."""
