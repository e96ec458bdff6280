"""DataFrame-to-DataFrame operators: quality rules, features, peaks, tariffs, star loading."""
