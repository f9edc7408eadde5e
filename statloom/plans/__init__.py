"""End-to-end flows over a season of player statistics."""
