"""Whole jobs: fact build, dimension builders, monthly load, analytic queries."""
