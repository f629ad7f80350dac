"""moodlake streaming."""
