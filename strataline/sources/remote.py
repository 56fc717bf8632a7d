"""A rate-limited search service as a Spark data source.

The service is asked page by page; slices are planned on the driver from counts, so that no slice
exceeds the service's cap, and read by one task in order unless ``parallel`` says otherwise: a
rate limit holds for all readers together. The transport is given by name; ``recorded`` answers
from a folder of recorded JSON responses and needs no network.
"""

from __future__ import annotations

import base64
import calendar
import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "id string, family_id string, country string, seq bigint"
PAGE, CAP = 100, 2000


#: Ids asked for at once.
BATCH = 20


class Recorded:
    """Answers from files of a folder; a missing file is an empty answer.

    Searches: ``<query, percent-encoded>.<begin>.json``; details and abstracts:
    ``<kind>.<ids joined by commas, percent-encoded>.json``.
    """

    def __init__(self, options: dict):
        self.folder = options["path"]

    def _read(self, name: str) -> str | None:
        path = os.path.join(self.folder, name)
        if not os.path.exists(path):
            return None
        with open(path, encoding="utf-8") as f:
            return f.read()

    def get(self, query: str, begin: int, end: int) -> dict:
        return json.loads(self._read(f"{urllib.parse.quote(query, safe='')}.{begin}.json") or "{}")

    def count(self, query: str) -> int:
        return total(self.get(query, 1, 1))

    def record(self, kind: str, ids: list[str]) -> str | None:
        return self._read(f"{kind}.{urllib.parse.quote(','.join(ids), safe='')}.json")


class Echo:
    """For dry runs: a record for every id that has country, number and kind; a request for any other id is refused whole."""

    def __init__(self, options: dict):
        pass

    def get(self, query: str, begin: int, end: int) -> dict:
        return {}

    def count(self, query: str) -> int:
        return 0

    def record(self, kind: str, ids: list[str]) -> str | None:
        docs = []
        for ident in ids:
            parts = ident.split(".")
            if len(parts) != 3 or not all(parts):
                return None
            own = {"@document-id-type": "docdb", **{k: {"$": v} for k, v in zip(("country", "doc-number", "kind"), parts)}}
            docs.append({"@family-id": "", "bibliographic-data": {"publication-reference": {"document-id": own}}})
        return json.dumps({"ops:world-patent-data": {"exchange-documents": {"exchange-document": docs}}})


class Http:
    """Asks the service at ``url`` (searches) and ``recordurl`` (with ``{ids}`` and ``{kind}``); key and secret come from options and are never logged.

    Each sort of request has a pause of its own: ``delay`` after a page, ``countdelay`` after a
    count, ``recorddelay`` after a batch of records, ``singledelay`` after a single one. They hold
    for all readers together: each of ``parallel`` readers pauses as many times as long.
    """

    RETRIES = 4

    def __init__(self, options: dict):
        self.url, self.token_url, self.record_url = options.get("url", ""), options.get("tokenurl"), options.get("recordurl", "")
        self.key, self.secret = options.get("key", ""), options.get("secret", "")
        readers = max(1, int(options.get("parallel", "1")))
        self.delays = {k: readers * float(options.get(k, default)) for k, default in (("delay", "15"), ("countdelay", "3"), ("recorddelay", "12"), ("singledelay", "5"))}
        self.lifetime = float(options.get("tokenseconds", "850"))
        self.token, self.until = "", 0.0

    def _token(self) -> str:
        if self.token_url and time.time() >= self.until:
            code = base64.b64encode(f"{self.key}:{self.secret}".encode()).decode()
            request = urllib.request.Request(self.token_url, b"grant_type=client_credentials", {"Authorization": f"Basic {code}"})
            with urllib.request.urlopen(request, timeout=60) as answer:
                self.token, self.until = json.load(answer)["access_token"], time.time() + self.lifetime
        return self.token

    def _ask(self, url: str, pause: str, **headers: str) -> str | None:
        """The text of the answer; None where the service has nothing for the request."""
        for attempt in range(self.RETRIES):
            request = urllib.request.Request(url, headers={"Authorization": f"Bearer {self._token()}", "Accept": "application/json", **headers})
            try:
                with urllib.request.urlopen(request, timeout=60) as answer:
                    text = answer.read().decode()
                time.sleep(self.delays[pause])
                return text
            except urllib.error.HTTPError as error:
                if error.code in (400, 404):
                    return None
                if error.code not in (403, 429, 500, 502, 503):
                    raise
                time.sleep(600 if error.code == 403 else 60 * (attempt + 1))
            except urllib.error.URLError:
                time.sleep(20)
        raise RuntimeError(f"no answer after {self.RETRIES} attempts")

    def get(self, query: str, begin: int, end: int, pause: str = "delay") -> dict:
        return json.loads(self._ask(f"{self.url}?q={urllib.parse.quote(query)}", pause, **{"X-OPS-Range": f"{begin}-{end}"}) or "{}")

    def count(self, query: str) -> int:
        return total(self.get(query, 1, 1, "countdelay"))

    def record(self, kind: str, ids: list[str]) -> str | None:
        url = self.record_url.replace("{ids}", urllib.parse.quote(",".join(ids), safe=",.")).replace("{kind}", kind)
        return self._ask(url, "recorddelay" if len(ids) > 1 else "singledelay")


TRANSPORTS = {"http": Http, "recorded": Recorded, "echo": Echo}


def _get(node, *names):
    for name in names:
        if not isinstance(node, dict):
            return None
        node = node.get(f"ops:{name}") or node.get(name)
    return node


def _list(node) -> list:
    return [] if node is None else node if isinstance(node, list) else [node]


def _text(node) -> str:
    value = node.get("$", "") if isinstance(node, dict) else node
    return "" if value is None else str(value)


def total(answer: dict) -> int:
    """The count that a search response states."""
    search = _get(answer, "world-patent-data", "biblio-search") or {}
    return int(search.get("@total-result-count") or 0)


def hits(answer: dict) -> Iterator[tuple[str, str, str]]:
    """``id``, ``family_id``, ``country`` of each hit: its first docdb id with country and number."""
    found = _get(answer, "world-patent-data", "biblio-search", "search-result", "publication-reference")
    for hit in _list(found):
        ids = [x for x in _list(_get(hit, "document-id")) if isinstance(x, dict) and x.get("@document-id-type") == "docdb"]
        if not ids:
            continue
        country, number, kind = (_text(ids[0].get(k)) for k in ("country", "doc-number", "kind"))
        number = number.replace(" ", "").replace(".", "")
        if country and number:
            yield ".".join(x for x in (country, number, kind) if x), str(hit.get("@family-id") or ""), country


def slices_of(query: str, year: int, count, applicant: str = "") -> list[tuple[str, int]]:
    """``(query, n)`` of the coarsest slices within the cap; a day above it is cut at the cap.

    ``applicant`` narrows every slice at the service.
    """
    if applicant:
        query = f'{query} AND pa="{applicant}"'

    def ranged(a: str, b: str) -> str:
        return f'{query} AND pd within "{a} {b}"'

    whole = f"{query} AND pd={year}"
    n = count(whole)
    if n == 0:
        return []
    if n <= CAP:
        return [(whole, n)]
    out = []
    for month in range(1, 13):
        days = calendar.monthrange(year, month)[1]
        text = ranged(f"{year}{month:02d}01", f"{year}{month:02d}{days:02d}")
        n = count(text)
        if n > CAP:
            for day in range(1, days + 1):
                one = ranged(*[f"{year}{month:02d}{day:02d}"] * 2)
                if d := count(one):
                    out.append((one, d))
        elif n:
            out.append((text, n))
    return out


class Slice(InputPartition):
    def __init__(self, parts: list[tuple[str, int]], first: int):
        self.parts, self.first = parts, first


class SearchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def _transport(self):
        return TRANSPORTS[self.options.get("transport", "http")](self.options)

    def partitions(self) -> list[Slice]:
        transport = self._transport()
        parts: list[tuple[str, int]] = []
        first, last = int(self.options["firstyear"]), int(self.options["lastyear"])
        for query in json.loads(self.options["queries"]):
            for year in range(first, last + 1):
                parts += slices_of(query, year, transport.count, self.options.get("applicant", ""))
        tasks = max(1, int(self.options.get("parallel", "1")))
        step = max(1, -(-len(parts) // tasks))
        return [Slice(parts[i : i + step], i) for i in range(0, len(parts), step)] or [Slice([], 0)]

    def read(self, partition: Slice) -> Iterator[tuple]:
        transport = self._transport()
        for number, (query, n) in enumerate(partition.parts):
            seen: set[str] = set()
            seq = (partition.first + number) * CAP
            for begin in range(1, min(n, CAP) + 1, PAGE):
                answer = transport.get(query, begin, begin + PAGE - 1)
                page = list(hits(answer))
                if not page:
                    break
                for ident, family, country in page:
                    if ident not in seen:
                        seen.add(ident)
                        yield ident, family, country, seq
                        seq += 1


class SearchSource(DataSource):
    """``spark.read.format("patent_search")``; options: queries (JSON list), firstyear, lastyear, applicant, transport, path or url."""

    @classmethod
    def name(cls) -> str:
        return "patent_search"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SearchReader:
        return SearchReader({k.lower(): v for k, v in self.options.items()})


def register(spark) -> None:
    spark.dataSource.register(SearchSource)


def records(ids: DataFrame, key: str, options: dict[str, str], kind: str = "biblio", batch: int = BATCH) -> DataFrame:
    """The records of ``ids`` as the service answers: ``first_id``, ``n_ids``, ``body``.

    Ids are asked for in batches; a batch that the service refuses is asked for id by id, so that a
    bad id costs nobody else theirs; it has a row of null ``body``. Null ids are ignored, repeated
    ones asked for once. ``parallel`` readers (an option, one by default) work at once.
    """
    readers = max(1, int(options.get("parallel", "1")))
    wanted = ids.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("id")).distinct()
    wanted = wanted.repartition(readers, "id").sortWithinPartitions("id")

    def answers(transport, asked: list[str]) -> list[tuple[str, int, str | None]]:
        try:
            body = transport.record(kind, asked)
        except RuntimeError:
            body = None
        if body is not None or len(asked) == 1:
            return [(asked[0], len(asked), body)]
        return [row for one in asked for row in answers(transport, [one])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transport = TRANSPORTS[options.get("transport", "http")](options)
        waiting: list[str] = []

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string()))], names=["first_id", "n_ids", "body"])

        for one in batches:
            waiting += one.column(0).to_pylist()
            while len(waiting) >= batch:
                yield rows(answers(transport, waiting[:batch]))
                waiting = waiting[batch:]
        yield rows(answers(transport, waiting) if waiting else [])

    return wanted.mapInArrow(run, "first_id string, n_ids int, body string")
