"""sparkledger.sources."""
