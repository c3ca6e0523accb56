"""sparkledger.plans."""
