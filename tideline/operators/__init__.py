"""DataFrame-to-DataFrame operators on chunks, series and observations."""
