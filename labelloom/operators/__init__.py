"""DataFrame-to-DataFrame operators. Nothing here collects rows of the input to the driver."""
