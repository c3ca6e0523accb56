"""sparkledger.functions."""
