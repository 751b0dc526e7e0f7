"""Session settings, adapters over the test tables and registered queries."""
