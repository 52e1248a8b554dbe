"""The incremental loads fed by Structured Streaming instead of a batch run."""
