"""The three layers, the questions asked of them, and the register of queries."""
