"""moodlake operators."""
