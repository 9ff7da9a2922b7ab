"""Reading, writing and assembling record tables."""
