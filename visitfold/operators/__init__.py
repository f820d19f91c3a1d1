"""DataFrame to DataFrame steps; none of them runs an action."""
