"""Training-data operators: filtering, tokens, search, duplicates, mixing and shards."""
