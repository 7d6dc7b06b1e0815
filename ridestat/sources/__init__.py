"""ridestat.sources."""
