"""Dataset plans: table specs, transforms of the five datasets, and the run that loads them."""
