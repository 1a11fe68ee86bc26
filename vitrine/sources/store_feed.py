"""The store's web feeds: an API client over a pluggable transport, and a Python data source on top of it.

``format("store_feed")`` has batch feeds ``players``, ``details``, ``reviews`` (one partition for each batch of
app ids) and streams ``reviews`` by cursor. Transports: ``base_url`` for HTTP, ``fixtures`` for a folder of recorded
answers, which is what tests and offline runs use.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

Transport = Callable[[str, dict], dict]
PAGE, TIMEOUT_S, WAIT_S, DETAIL_WAIT_S = 100, 30, 0.5, 1.5


class StoreError(RuntimeError):
    """A request failed; carries the status and the start of the answer."""


#: Fixed values of the wire format: host (API or store) and path of each feed, and parameters that every request of it has.
ENDPOINTS = {
    "app_list": ("api", "IStoreService/GetAppList/v1/", {}),
    "players": ("api", "ISteamUserStats/GetNumberOfCurrentPlayers/v1/", {}),
    "details": ("store", "api/appdetails", {}),
    "reviews": ("store", "appreviews/{appid}", {"json": 1, "purchase_type": "all"}),
    "query": ("api", "IStoreQueryService/Query/v1/", {}),
}


def request_url(hosts: dict[str, str], endpoint: str, params: dict) -> str:
    """Address of a request; what the path names is no parameter."""
    host, path, always = ENDPOINTS[endpoint]
    named = {k for k in params if f"{{{k}}}" in path}
    rest = {k: str(v).lower() if isinstance(v, bool) else v for k, v in {**always, **params}.items() if k not in named}
    return f"{hosts[host].rstrip('/')}/{path.format(**{k: params[k] for k in named})}?{urllib.parse.urlencode(rest)}"


def http_transport(api_url: str, store_url: str) -> Transport:
    """Requests to the two hosts; whatever fails (status, connection, time, no JSON) is a :class:`StoreError`."""

    def get(endpoint: str, params: dict) -> dict:
        try:
            with urllib.request.urlopen(request_url({"api": api_url, "store": store_url}, endpoint, params), timeout=TIMEOUT_S) as answer:  # noqa: S310
                return json.load(answer)
        except urllib.error.HTTPError as e:
            raise StoreError(f"{endpoint}: status {e.code}: {e.read(500)!r}") from e
        except (OSError, ValueError) as e:
            raise StoreError(f"{endpoint}: {type(e).__name__}: {e}"[:500]) from e

    return get


def request_key(endpoint: str, params: dict) -> str:
    """Name of a recorded answer: the endpoint and a digest of its parameters."""
    plain = json.dumps({k: str(v) for k, v in params.items()}, sort_keys=True)
    return f"{endpoint.replace('/', '_')}-{hashlib.sha256(plain.encode()).hexdigest()[:16]}.json"


def replay_transport(folder: str) -> Transport:
    """Recorded answers by :func:`request_key`; any store that pyarrow opens."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)

    def get(endpoint: str, params: dict) -> dict:
        try:
            with store.open_input_stream(f"{root}/{request_key(endpoint, params)}") as f:
                return json.loads(f.read())
        except FileNotFoundError as e:
            raise StoreError(f"{endpoint}: no recorded answer for {params}") from e

    return get


class StoreApi:
    """Feeds as plain methods. ``wait`` is called between the requests of a paged feed."""

    def __init__(self, transport: Transport, wait: Callable[[float], None] = time.sleep, key: str = ""):
        self._get, self._wait, self._key = transport, wait, key

    def app_list(self, max_results: int = 50_000, include_games: bool = True, include_dlc: bool = False, include_software: bool = False) -> list[dict]:
        """Whole catalogue, by keyset pages."""
        out, last = [], 0
        while True:
            page = self._get("app_list", {"key": self._key, "max_results": max_results, "last_appid": last, "include_games": include_games, "include_dlc": include_dlc, "include_software": include_software}).get("response", {})
            out += page.get("apps", [])
            if not page.get("have_more_results"):
                return out
            last = page["last_appid"]
            self._wait(WAIT_S)

    def current_players(self, appid: int) -> int | None:
        answer = self._get("players", {"appid": appid}).get("response", {})
        return answer["player_count"] if answer.get("result") == 1 else None

    def app_details(self, appid: int, cc: str = "kr", language: str = "korean") -> dict | None:
        answer = self._get("details", {"appids": appid, "cc": cc, "l": language}).get(str(appid), {})
        return answer["data"] if answer.get("success") else None

    def review_pages(self, appid: int, language: str, start: str = "*", limit: int | None = None, order: str = "recent") -> Iterator[tuple[list[dict], str]]:
        """(reviews, next cursor) page by page; ends at an empty page, a repeated cursor or ``limit``.

        A failing request raises: a broken crawl must not look like a finished one.
        """
        cursor, left, seen = start, limit, {start}
        while left is None or left > 0:
            size = PAGE if left is None else min(PAGE, left)
            answer = self._get("reviews", {"appid": appid, "language": language, "cursor": cursor, "filter": order, "num_per_page": size})
            rows = answer.get("reviews", []) if answer.get("success") == 1 else []
            if not rows:
                return
            cursor = answer.get("cursor", cursor)
            yield rows, cursor
            left = None if left is None else left - len(rows)
            if cursor in seen:
                return
            seen.add(cursor)
            self._wait(WAIT_S)

    def reviews(self, appid: int, cursors: dict[str, str], languages: list[str], limit: int | None = None, order: str = "recent") -> tuple[list[dict], dict[str, str]]:
        """Reviews of several languages, each id once, and the cursors to go on from."""
        out, ids, after = [], set(), dict(cursors)
        for language in languages:
            for rows, cursor in self.review_pages(appid, language, cursors.get(language, "*"), limit, order):
                after[language] = cursor
                for r in rows:
                    if r.get("recommendationid") not in ids:
                        ids.add(r.get("recommendationid"))
                        out.append(r)
        return out, after

    # Fixed values of the wire format: the names of the query's parameters, filters and parts.

    def query(self, start: int = 0, count: int = 1000, sort: int = 0, filters: dict | None = None, context: dict | None = None, data_request: dict | None = None, name: str = "") -> dict:
        """Store query; the nested request travels as one JSON parameter."""
        request = {"query_name": name, "query": {"start": start, "count": count, "sort": sort, "filters": filters or {}}, "context": context or {}, "data_request": data_request or {}}
        return self._get("query", {"key": self._key, "input_json": json.dumps(request, sort_keys=True)})

    def discounted(self, count: int = 400, min_discount: int = 1, language: str = "korean", country: str = "KR") -> dict:
        """The standing query: released, paid games on discount, best sellers first, with names and prices; the filters run at the server."""
        filters = {"released_only": True, "type_filters": {"include_games": True}, "price_filters": {"exclude_free_items": True, "min_discount_percent": min_discount}}
        wanted = {"include_basic_info": True, "include_all_purchase_options": True}
        return self.query(0, count, 12, filters, {"language": language, "country_code": country}, wanted)


FEEDS = {
    "players": "appid INT, player_count INT, collected_at STRING",
    "details": "appid INT, detail STRING, collected_at STRING",
    # The cursor behind a review's page, and the page's number.
    "reviews": "appid INT, language STRING, review STRING, page INT, cursor STRING",
}


class Bucket:
    """A token bucket: ``rate`` requests a second, up to ``burst`` at once; :meth:`take` waits for the next one. What one task is allowed."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.left, self.at = float(burst), clock()

    def take(self) -> None:
        now = self.clock()
        self.left, self.at = min(self.burst, self.left + (now - self.at) * self.rate), now
        self.left -= 1
        if self.left < 0:
            self.sleep(-self.left / self.rate)


#: Requests a second of the whole application unless the option ``requests_per_second`` is given, by feed: the store's usual waits, for eight at a time
#: with reviews and one at a time else.
RATES = {"players": 1 / WAIT_S, "reviews": 8 / WAIT_S, "details": 1 / DETAIL_WAIT_S}


def share_of_budget(options: dict, feed: str, partitions: int) -> float:
    """Requests a second for each of the partitions that may run at once, so that all of them together keep to the budget at any number of tasks.

    At most ``slots`` tasks (cores of the application, if the option tells them) run at once, so more partitions than that don't thin out the rate."""
    budget = float(options.get("requests_per_second", RATES[feed]))
    if budget <= 0:
        raise ValueError("requests_per_second must be above 0")
    return budget / max(1, min(partitions, int(options.get("slots", partitions))))


def _api(options: dict, bucket: Bucket | None = None) -> StoreApi:
    """With a bucket each request takes from it, and pages need no waits of their own."""
    transport = replay_transport(options["fixtures"]) if options.get("fixtures") else http_transport(options["api_url"], options["store_url"])
    if bucket is None:
        return StoreApi(transport, (lambda s: None) if options.get("fixtures") else time.sleep, options.get("key", ""))

    def get(endpoint: str, params: dict) -> dict:
        bucket.take()
        return transport(endpoint, params)

    return StoreApi(get, lambda s: None, options.get("key", ""))


def _bucket(options: dict, feed: str, partitions: int) -> Bucket | None:
    """Recorded answers need no budget unless one is asked for."""
    if options.get("fixtures") and "requests_per_second" not in options:
        return None
    return Bucket(share_of_budget(options, feed, partitions))


def _tells_errors(options: dict) -> bool:
    return options.get("errors", "false") == "true"


class AppBatch(InputPartition):
    """Some games, and the number of such batches, which share the request budget."""

    def __init__(self, app_ids: list[int], of: int = 1):
        self.app_ids, self.of = app_ids, of


class StoreFeedReader(DataSourceReader):
    """Partitions are batches of app ids (``workers`` of them), which share one request budget. Failed apps are skipped
    unless all of a partition fail, and are named in the task's error then; with the option ``errors`` each gives
    a row of its id and its ``error`` instead."""

    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        ids = [int(x) for x in self.options.get("app_ids", "").split(",") if x.strip()]
        n = max(1, min(int(self.options.get("workers", "1")), len(ids) or 1))
        return [AppBatch(ids[i::n], n) for i in range(n)]

    def read(self, partition):
        feed, failed = self.options["feed"], []
        api = _api(self.options, _bucket(self.options, feed, partition.of))
        now = self.options.get("now") or datetime.now(timezone.utc).isoformat()
        cursors = json.loads(self.options.get("cursors", "{}"))
        told = (None,) if _tells_errors(self.options) else ()
        for appid in partition.app_ids:
            try:
                if feed == "players":
                    yield appid, api.current_players(appid), now, *told
                elif feed == "details":
                    detail = api.app_details(appid, self.options.get("cc", "kr"), self.options.get("language", "korean"))
                    yield appid, None if detail is None else json.dumps(detail), now, *told
                else:
                    for language in self.options.get("languages", "korean,english").split(","):
                        limit = int(self.options["limit"]) if "limit" in self.options else None
                        for page, (rows, cursor) in enumerate(api.review_pages(appid, language, cursors.get(f"{appid}/{language}", "*"), limit), 1):
                            for r in rows:
                                yield appid, language, json.dumps(r), page, cursor, *told
            except StoreError as e:
                failed.append(f"{appid}: {e}")
                if told:
                    yield appid, *[None] * FEEDS[feed].count(","), str(e)
        if not told and failed and len(failed) == len(partition.app_ids):
            raise StoreError("; ".join(failed)[:2000])


class FeedBatch(InputPartition):
    """Feeds (game, language) of one task and where each stands: cursor, pages so far, and ``end`` (a page that answered with its own cursor: there is no
    more) or ``idle`` (no more for now). With it the pages that it may fetch of each, the batch, and the task's number of how many."""

    def __init__(self, feeds: list[tuple[int, str, list]], pages: int, batch: int, number: int, of: int):
        self.feeds, self.pages, self.batch, self.number, self.of = feeds, pages, batch, number, of


class ReviewStream(DataSourceStreamReader):
    """Reviews behind cursors, fetched by the tasks: the driver asks for no page.

    The offset is the number of the batch. Where a batch ends, the cursors behind its pages, is known only when its tasks have run; so each task writes
    what it reached to ``state`` (a folder that driver and executors share), and the next batch starts from there. A task that runs again for the same
    batch (a lost executor, a restart before the batch was committed) finds the note, if it was written, and fetches up to the same pages again. None is
    lost; readers dedupe by id.

    A batch takes up to ``pages_per_batch`` pages of each feed, and ``pages_in_all`` of all feeds together (at least one of each), so it stays bounded.
    Options: ``state``, ``app_ids``, ``languages``, ``workers`` (tasks), ``requests_per_second`` (of all tasks), ``slots``.
    """

    def __init__(self, options: dict):
        self.options = options
        self.notes = Notes(options["state"])
        self.targets = [(int(a), lang) for a in options["app_ids"].split(",") for lang in options.get("languages", "korean,english").split(",")]

    def initialOffset(self):
        return {"batch": 0}

    def latestOffset(self):
        """One batch further: feeds may have new pages at any time."""
        return {"batch": self.notes.last_batch() + 1}

    def partitions(self, start, end):
        n = max(1, min(int(self.options.get("workers", "8")), len(self.targets)))
        pages = int(self.options.get("pages_per_batch", "50"))
        if "pages_in_all" in self.options:
            pages = max(1, min(pages, int(self.options["pages_in_all"]) // len(self.targets)))
        at = self.notes.read(start["batch"])
        return [FeedBatch([(a, lang, at.get(f"{a}/{lang}", ["*", 0])) for a, lang in self.targets[i::n]], pages, end["batch"], i, n) for i in range(n)]

    def read(self, partition):
        api = _api(self.options, _bucket(self.options, "reviews", partition.of))
        before, reached = self.notes.read(partition.batch), {}
        for appid, language, at in partition.feeds:
            key = f"{appid}/{language}"
            cursor, page = at[:2]
            left = before[key][1] - page if key in before else 0 if at[2:] == ["end"] else partition.pages
            state = at[2:] if not left else ["idle"]
            for rows, after in api.review_pages(appid, language, cursor) if left else ():
                page += 1
                state = ["end"] if after == cursor else []
                cursor = after
                for r in rows:
                    yield appid, language, json.dumps(r), page, after
                left -= 1
                if not left:
                    break
            reached[key] = before.get(key) or [cursor, page, *(state if not left or state == ["end"] else ["idle"])]
        self.notes.write(partition.batch, partition.number, reached)

    def commit(self, end):
        """Notes of batches before the one that was committed are no longer asked for."""
        self.notes.forget(end["batch"])


class Notes:
    """Where feeds stand behind each batch: one small object for each task, on any store that pyarrow opens. An object appears whole."""

    def __init__(self, root: str):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)

    def _list(self, folder: str) -> list:
        from pyarrow import fs

        return sorted(self.fs.get_file_info(fs.FileSelector(folder, allow_not_found=True)), key=lambda f: f.base_name)

    def batches(self) -> list[int]:
        return [int(f.base_name) for f in self._list(self.root) if f.base_name.isdigit()]

    def last_batch(self) -> int:
        return max([0, *self.batches()])

    def read(self, batch: int) -> dict[str, list]:
        """By ``appid/language``; a feed without a note starts anew."""
        out = {}
        for f in self._list(f"{self.root}/{batch:09d}"):
            if f.base_name.endswith(".json"):
                with self.fs.open_input_stream(f.path) as note:
                    out |= json.loads(note.read())
        return out

    def write(self, batch: int, number: int, reached: dict[str, list]) -> None:
        name = f"{self.root}/{batch:09d}/{number}.json"
        self.fs.create_dir(f"{self.root}/{batch:09d}", recursive=True)
        part = f"{name}.{os.getpid()}-{time.monotonic_ns()}.part"
        with self.fs.open_output_stream(part) as f:
            f.write(json.dumps(reached).encode())
        self.fs.move(part, name)

    def forget(self, batch: int) -> None:
        for b in self.batches():
            if b < batch:
                self.fs.delete_dir(f"{self.root}/{b:09d}")


class StoreFeedSource(DataSource):
    @classmethod
    def name(cls):
        return "store_feed"

    def schema(self):
        return FEEDS[self.options.get("feed", "reviews")] + ", error STRING" * _tells_errors(self.options)

    def reader(self, schema):
        return StoreFeedReader(dict(self.options))

    def streamReader(self, schema):
        return ReviewStream(dict(self.options))
