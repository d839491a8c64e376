"""Settings of the boosted stumps that the catalog and its SQL both grow."""

#: Rate, least gain, L1 and L2 of the boosted stumps, their features and the bounds between bins.
STUMP_SETTINGS = [(0.3, 0.0, 0.0, 1.0), (0.3, 1.5, 0.0, 0.1), (0.1, 0.0, 2.0, 1.0), (0.8, 0.5, 0.5, 5.0)]
STUMP_FEATURES = ["rate", "hash_rate_mean", "active_count", "trends", "influencer_appearances"]
STUMP_CUTS = [0, 1, 2, 4, 8, 16, 32, 64, 128, 256]
