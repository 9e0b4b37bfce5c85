"""Reading deliveries and merging the endpoints of one feed."""
