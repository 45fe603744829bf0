"""Customer-review analytics and rating models as Spark jobs."""
