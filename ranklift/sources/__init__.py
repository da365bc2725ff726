"""Loading, checking and persisting tables."""
