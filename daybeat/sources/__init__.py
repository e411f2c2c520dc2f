"""Reading, role binding and writing of tracker tables."""
