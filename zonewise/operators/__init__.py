"""DataFrame in, DataFrame out. No actions except in model fits."""
