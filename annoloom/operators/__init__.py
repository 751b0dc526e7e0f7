"""DataFrame operators over the tables described in ``annoloom.schema``."""
