"""Analytics on labelled grids, label graphs and the tables derived from them, for Spark."""
