"""DataFrame -> DataFrame operators (no actions unless documented)."""
