"""Market, access and identity analytics for a payer-and-provider network, on Spark."""
