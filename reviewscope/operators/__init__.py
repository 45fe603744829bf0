"""DataFrame-to-DataFrame operators over the review table."""
