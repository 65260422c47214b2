"""Composed plans: fixture frames over the driver tables, data products,
the registered queries and their SQL oracles, and the batch job."""
