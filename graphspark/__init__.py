"""Property-graph networks and edge lists to knowledge graphs, on Spark DataFrames."""
