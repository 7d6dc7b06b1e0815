"""ridestat.operators."""
