"""Ready-made jobs: the test tables as time series, the registered queries and their SQL."""
