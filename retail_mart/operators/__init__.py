"""DataFrame -> DataFrame operators of the mart."""
