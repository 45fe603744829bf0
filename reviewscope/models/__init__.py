"""Text sentiment, trees on ids, and recommendations, all on Spark ML."""
