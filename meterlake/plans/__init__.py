"""Queries over the star: views and marts, period listings, period reports."""
