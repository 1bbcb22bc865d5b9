"""Full and delta loads of the published fact tables."""
