"""ridestat.functions."""
