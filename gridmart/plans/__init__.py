"""Model plans: staging relations, marts, replica refresh, exports, runs."""
