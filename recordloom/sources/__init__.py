"""Reading, writing and generating records."""
