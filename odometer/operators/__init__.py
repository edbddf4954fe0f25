"""DataFrame -> DataFrame operators; batch and streaming input alike where meaningful."""
