"""sparkledger.operators."""
