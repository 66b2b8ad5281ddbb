"""End-to-end jobs: land, profile, bronze -> silver, silver -> gold, report."""
