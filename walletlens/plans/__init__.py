"""End-to-end plans: the batch pipeline, sample views, registered queries and their SQL."""
