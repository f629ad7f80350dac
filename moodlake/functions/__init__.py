"""moodlake functions."""
