"""moodlake sources."""
