"""Reading and writing the hand-off files."""
