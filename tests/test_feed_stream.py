"""The review stream: pages are fetched by tasks, batches are bounded, restarts lose nothing, and requests keep to their budget."""

import json
import time

import pytest

from vitrine.session import ship
from vitrine.sources import store_feed
from vitrine.sources.store_feed import Bucket, Notes, ReviewStream, StoreFeedReader, StoreFeedSource, request_key, share_of_budget
from vitrine.streaming.reviews import drain_reviews, last_cursors


def answers(folder, games, pages):
    """``pages`` pages of two reviews for each game, then an empty one; game 1 ends with a page that answers with its own cursor."""
    folder.mkdir(exist_ok=True)

    def put(app, cursor, rows, after):
        name = request_key("reviews", {"appid": app, "language": "english", "cursor": cursor, "filter": "recent", "num_per_page": 100})
        (folder / name).write_text(json.dumps({"success": 1, "reviews": rows, "cursor": after}))

    for app in range(1, games + 1):
        for p in range(pages):
            own = app == 1 and p == pages - 1
            at = f"c{p}" if p else "*"
            put(app, at, [{"recommendationid": f"{app}-{p}-{i}"} for i in range(2)], at if own else f"c{p + 1}")
        put(app, f"c{pages}", [], f"c{pages}")
    return {"fixtures": str(folder), "app_ids": ",".join(map(str, range(1, games + 1))), "languages": "english"}


def ids(spark, out):
    return sorted(json.loads(r["review"])["recommendationid"] for r in spark.read.parquet(out).collect())


def test_batches(spark, tmp_path):
    """Two pages of each feed a batch; new pages of a later day are found; all of them once."""
    options = {**answers(tmp_path / "a", 3, 5), "pages_per_batch": "2", "workers": "2"}
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    assert drain_reviews(spark, options, out, state) == 3
    want = sorted(f"{a}-{p}-{i}" for a in (1, 2, 3) for p in range(5) for i in range(2))
    assert ids(spark, out) == want and last_cursors(state) == {"1/english": "c4", "2/english": "c5", "3/english": "c5"}
    assert drain_reviews(spark, options, out, state) == 1 and ids(spark, out) == want
    name = request_key("reviews", {"appid": 2, "language": "english", "cursor": "c5", "filter": "recent", "num_per_page": 100})
    (tmp_path / "a" / name).write_text(json.dumps({"success": 1, "reviews": [{"recommendationid": "new"}], "cursor": "c6"}))
    (tmp_path / "a" / request_key("reviews", {"appid": 2, "language": "english", "cursor": "c6", "filter": "recent", "num_per_page": 100})).write_text(json.dumps({"success": 1}))
    drain_reviews(spark, options, out, state)
    assert ids(spark, out) == sorted([*want, "new"])


def test_restart(spark, tmp_path, monkeypatch):
    """A failing page fails the batch; the next start goes on from what was committed, and every page arrives once."""
    options = {**answers(tmp_path / "a", 3, 3), "pages_per_batch": "2", "workers": "3"}
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    missing = tmp_path / "a" / request_key("reviews", {"appid": 3, "language": "english", "cursor": "c2", "filter": "recent", "num_per_page": 100})
    kept = missing.read_text()
    missing.unlink()
    with pytest.raises(Exception, match="no recorded answer"):
        drain_reviews(spark, options, out, state)
    missing.write_text(kept)
    drain_reviews(spark, options, out, state)
    assert ids(spark, out) == sorted(f"{a}-{p}-{i}" for a in (1, 2, 3) for p in range(3) for i in range(2))


def test_task_again(tmp_path):
    """A task that runs again for its batch gives the same rows, also when the feed has grown; the driver fetches nothing."""
    options = {**answers(tmp_path / "a", 1, 2), "state": str(tmp_path / "s"), "pages_per_batch": "5", "workers": "1"}
    options["app_ids"] = "1"
    stream = ReviewStream(options)
    parts = stream.partitions(stream.initialOffset(), stream.latestOffset())
    first = list(stream.read(parts[0]))
    options2 = {**answers(tmp_path / "a", 1, 4), "state": str(tmp_path / "s"), "pages_per_batch": "5", "workers": "1"}
    assert [r[:4] for r in ReviewStream(options2).read(parts[0])] == [r[:4] for r in first] and len(first) == 4
    # Nothing but the notes is read to plan: there are no answers at this place.
    planned = ReviewStream({**options, "fixtures": str(tmp_path / "none")})
    assert planned.latestOffset() == {"batch": 2} and len(planned.partitions({"batch": 1}, {"batch": 2})) == 1


def test_pages_in_all(tmp_path):
    options = {"state": str(tmp_path), "app_ids": "1,2,3,4", "languages": "a,b", "pages_in_all": "16", "workers": "3"}
    parts = ReviewStream(options).partitions({"batch": 0}, {"batch": 1})
    assert [p.pages for p in parts] == [2, 2, 2] and sorted(len(p.feeds) for p in parts) == [2, 3, 3]
    assert {p.pages for p in ReviewStream({**options, "pages_in_all": "1"}).partitions({"batch": 0}, {"batch": 1})} == {1}


def test_notes(tmp_path):
    notes = Notes(str(tmp_path / "n"))
    assert notes.read(0) == {} and notes.last_batch() == 0
    notes.write(1, 0, {"1/a": ["x", 1]})
    notes.write(1, 1, {"2/a": ["y", 2, "idle"]})
    notes.write(2, 0, {"1/a": ["z", 2]})
    assert notes.read(1) == {"1/a": ["x", 1], "2/a": ["y", 2, "idle"]} and notes.last_batch() == 2
    notes.forget(2)
    assert notes.batches() == [2]


def test_bucket():
    """No second sees more requests than the rate, besides the burst."""
    now, asked = [0.0], []
    bucket = Bucket(4, 2, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for i in range(40):
        bucket.take()
        asked.append(now[0])
        now[0] += 0.01 if i % 7 else 0.6
    for t in asked:
        assert sum(t <= x < t + 1 for x in asked) <= 4 + 2


@pytest.mark.parametrize("workers", [1, 3, 7])
def test_budget_of_all_tasks(spark, tmp_path, monkeypatch, workers):
    """Requests of all tasks together keep to the budget, whatever their number."""
    options = answers(tmp_path / "a", 12, 1)
    feed = {**options, "feed": "reviews", "workers": str(workers), "requests_per_second": "40"}
    rates = [share_of_budget(feed, "reviews", p.of) for p in StoreFeedReader(feed).partitions()]
    assert len(rates) == workers and abs(sum(rates) - 40) < 1e-9
    assert share_of_budget({**feed, "slots": "2"}, "reviews", 10) == 20 and share_of_budget({}, "details", 3) == pytest.approx(1 / 1.5 / 3)
    with pytest.raises(ValueError):
        share_of_budget({"requests_per_second": "0"}, "players", 1)
    ship(spark)
    spark.dataSource.register(StoreFeedSource)
    began = time.time()
    assert spark.read.format("store_feed").options(**feed).load().count() == 24
    # 24 requests, of which each task may ask the first at once.
    assert time.time() - began >= (23 - workers) / 40
    assert store_feed.RATES["details"] < store_feed.RATES["players"]
