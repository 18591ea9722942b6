"""Jobs: each is a function of a session and plain paths, with a command line."""
