"""Tables, files and record streams: where rows come from and go to."""
