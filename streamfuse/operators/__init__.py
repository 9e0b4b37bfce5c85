"""Selection, deduplication, counts and health as DataFrame transformations."""
