"""The stages: normalize, profile, clean, wrangle, reports, features, training, metrics."""
