"""Training-data operators: cleaning, deduplicating, mixing and packaging document tables at scale."""
