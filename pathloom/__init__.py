"""Analytics over robot rollouts and trajectories, and training-data operators, on Spark."""
