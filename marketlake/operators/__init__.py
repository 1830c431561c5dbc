"""DataFrame transforms and table loads."""
