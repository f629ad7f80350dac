"""moodlake plans."""
