"""sparkledger.streaming."""
