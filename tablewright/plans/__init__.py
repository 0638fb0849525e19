"""The game-catalogue preset and its jobs."""
