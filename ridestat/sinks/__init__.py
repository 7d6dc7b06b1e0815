"""ridestat.sinks."""
