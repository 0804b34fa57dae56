"""DataFrame-to-DataFrame operators of the cost audit."""
