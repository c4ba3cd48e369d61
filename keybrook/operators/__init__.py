"""DataFrame operators that work on bounded data and inside micro-batches."""
