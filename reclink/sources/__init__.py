"""Reading, shaping and queueing of incoming data."""
