"""DataFrame -> DataFrame operators (cleaning, rollups, quality, windows,
features, isolation forest, scoring)."""
