"""Column functions of the space and time axes, versions and dates."""
