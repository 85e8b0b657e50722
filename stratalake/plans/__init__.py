"""Silver and Gold models, incremental-load state, audit, and the batch that ties them together."""
