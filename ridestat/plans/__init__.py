"""ridestat.plans."""
