"""moodlake: mood analytics for song plays, built on Spark DataFrames.

Main entry points (see README.md for the full operator map):

* ``get_session`` / ``checkpoint_dir`` — session defaults and the shared scratch folder
* ``score_texts`` / ``score_plays`` — lexicon scoring of texts and of play records
* ``run_scoring`` / ``stream_trend`` — the scoring and trend streams
"""

from moodlake.session import checkpoint_dir, get_session
from moodlake.operators.scoring import score_plays, score_texts
from moodlake.streaming.scoring import run_scoring
from moodlake.streaming.trend import stream_trend

__all__ = ["get_session", "checkpoint_dir", "score_texts", "score_plays", "run_scoring", "stream_trend"]
