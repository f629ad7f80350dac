"""Sources: library listing (S4), JSON lines (S2), item pages (S3)."""

import json
import os

from moodlake.functions import envelope as env
from moodlake.sources.frames import read_json_lines
from moodlake.sources.library import read_library
from moodlake.sources.pages import read_item_pages


def touch(path):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(b"x")  # zero-byte files are skipped by the file listing


def test_read_library(spark, tmp):
    for rel in ["songs/A - B.mp3", "albums/My Album/C - D.mp3", "playlists/Road+Trip %20/E - F - G.mp3",
                "songs/notes.txt"]:
        touch(os.path.join(tmp, rel))
    rows = {r.path: r for r in read_library(spark, tmp).collect()}
    assert set(rows) == {"songs/A - B.mp3", "albums/My Album/C - D.mp3", "playlists/Road+Trip %20/E - F - G.mp3"}
    assert rows["songs/A - B.mp3"].container is None
    assert rows["playlists/Road+Trip %20/E - F - G.mp3"].container == "Road+Trip %20"


def test_read_json_lines_and_unwrap(spark, tmp):
    p = os.path.join(tmp, "in.jsonl")
    with open(p, "w") as f:
        f.write(json.dumps({"message": json.dumps({"topic": "t", "id": "1"}), "host": "h"}) + "\n")
    df = read_json_lines(spark, p)
    assert df.columns == ["message"]
    outer = df.selectExpr("get_json_object(message, '$.message') AS message")
    parsed = env.parse_envelope(outer, value="message").first()
    assert parsed.topic == "t" and parsed.id == "1"


def test_read_item_pages(spark, tmp):
    p = os.path.join(tmp, "pages.json")
    with open(p, "w") as f:
        for off in (0, 2):
            items = [{"track": {"id": f"{off + i}", "name": f"S{off + i}", "artists": [{"name": "A"}],
                                "album": {"images": []}}} for i in range(2)]
            f.write(json.dumps({"offset": off, "items": items}) + "\n")
    flat = env.flatten_tracks(env.explode_items(read_item_pages(spark, p)))
    got = sorted((r.position, r.id) for r in flat.collect())
    assert got == [(0, "0"), (1, "1"), (2, "2"), (3, "3")]


def test_read_library_relative_root(spark, tmp, monkeypatch):
    touch(os.path.join(tmp, "lib", "songs", "A - B.mp3"))
    monkeypatch.chdir(tmp)
    rows = read_library(spark, "lib").collect()
    assert [(r.kind, r.container, r.file_name, r.path) for r in rows] == [("songs", None, "A - B.mp3", "songs/A - B.mp3")]
