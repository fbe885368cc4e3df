"""Remote search services as a Python Data Source: ``spark.read.format("corpus_search")``.

A reader plans pages of ids, or, for a query that is over the service's cap, of its years, months and days, and beyond that
of a second field. Parts are disjoint, and the counts of the parts of any split must sum up to the count of the whole: what
has no date fine enough is a part of its own, asked for by what it isn't, and a difference that is left raises. So no id is
lost without a word. The transport is a class named by the option ``client`` ("module:Class") with ``count(query)`` and
``page(query, start, size)``. Credentials come from the environment of the client only: a client with ``rotate()`` takes its
next ones after a refusal.

``corpus_cursor`` reads services that page by cursor (``cursor(query, mark, size)`` gives ids and the next mark), and
``corpus_works`` reads records in batches of DOIs (``works(dois)``, then ``work(doi)`` for each if a batch is refused).

All tasks of a read together keep to the option ``requests_per_second`` and to ``daily_budget``. Requests are dealt out
before they run: a read has at most ``parallel`` partitions, partition i of n owns every n-th slot of one schedule of
requests, counted from when the read was planned, and its share of the budget. No two tasks have to agree on a counter.
"""

from __future__ import annotations

import importlib
import math
import time
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

PAGE, CAP = 5_000, 10_000


PARALLEL = 8
#: Parts of what is over the cap on one day: by the words that titles begin words with.
FACETS = ";".join(f"{c}*[ti]" for c in "tasiopcmfrbdhelwnguvkjqyxz")


@dataclass
class Page:
    query: str
    start: int
    size: int


@dataclass
class Pages(InputPartition):
    """Pages that one task asks for, the number of its slots among ``of``, and when the schedule began."""

    pages: list
    slot: int
    of: int
    origin: float


def dealt(pages: list, parallel: int, origin: float | None = None) -> list[Pages]:
    n = min(len(pages), max(1, parallel))
    origin = time.time() if origin is None else origin
    return [Pages(pages[i::n], i, n, origin) for i in range(n)]


def client_of(name: str, options: dict | None = None):
    module, _, kind = name.partition(":")
    made = getattr(importlib.import_module(module), kind)
    return made.of(options or {}) if hasattr(made, "of") else made()


class Unreconciled(RuntimeError):
    """The parts of a query don't have the records of the whole, or a part can't be made small enough."""


def split(
    client, query: str, want: int, last_year: int, first_year: int = 1950, cap: int = CAP, facets: str = FACETS, page: int = PAGE
) -> list[Page]:
    """Pages of a query: as it is below the cap, else of its parts, newest first, until ``want`` ids are covered."""
    out: list[Page] = []
    got = 0

    def take(own: str, n: int):
        nonlocal got
        n = min(n, want - got)
        out.extend(Page(own, s, min(page, n - s)) for s in range(0, n, page))
        got += n

    def parts(own: str, n: int, finer: list, rest: str, beyond):
        """``finer``: (query, how to split that) of disjoint parts; ``rest``: the query of what is in none of them, which
        is split by ``beyond``."""
        seen = 0
        for inner, further in finer:
            if got >= want:
                return
            k = client.count(inner)
            seen += k
            small(inner, k, further)
        if got < want and seen != n:
            k = client.count(rest) if seen < n else 0
            if seen + k != n:
                raise Unreconciled(f"{own}: {n} records, but {seen} in its parts and {k} in none")
            small(rest, k, beyond)

    def small(own: str, n: int, further):
        if n <= cap:
            take(own, n)
        elif further is None:
            raise Unreconciled(f"{own}: {n} records are over the cap of {cap} and can't be split")
        else:
            parts(own, n, *further())

    def by_facet(own: str, terms: list[str]):
        """Each term without those before it, so parts are disjoint; a part that is still too large goes by the terms left."""
        if not terms or terms == [""]:
            return None

        def further():
            cut = lambda k: f"({own})" + "".join(f" NOT {t}" for t in terms[:k])
            finer = [(f"({cut(k)}) AND {t}", by_facet(f"({cut(k)}) AND {t}", terms[k + 1 :])) for k, t in enumerate(terms)]
            return finer, cut(len(terms)), None

        return further

    def of_all(own: str):
        return by_facet(own, facets.split(";"))

    def dated(stamp: str) -> str:
        return f"({query}) AND {stamp}[pdat]"

    def by_day(month: str):
        days = [dated(f"{month}/{d:02d}") for d in range(1, 32)]
        rest = f"({dated(month)}) NOT {month}/01:{month}/31[pdat]"
        return lambda: ([(d, of_all(d)) for d in days], rest, of_all(rest))

    def by_month(year: int):
        months = [f"{year}/{k:02d}" for k in range(1, 13)]
        rest = f"({dated(str(year))}) NOT {year}/01:{year}/12[pdat]"
        return lambda: ([(dated(m), by_day(m)) for m in months], rest, of_all(rest))

    def by_year():
        years = range(last_year, first_year - 1, -1)
        rest = f"({query}) NOT {first_year}:{last_year}[pdat]"
        return [(dated(str(y)), by_month(y)) for y in years], rest, of_all(rest)

    small(query, client.count(query), by_year)
    return out


class BudgetSpent(RuntimeError):
    """A partition's share of the daily budget is used up."""


class Pacer:
    """Requests of one task: each in a slot of its own of a schedule of ``rate`` a second that ``of`` tasks share, at most
    ``budget`` in all, with retries after growing pauses."""

    def __init__(
        self, client, rate: float, budget: int | None = None, attempts: int = 5, sleep=time.sleep, slot: int = 0, of: int = 1, origin: float | None = None, clock=time.time
    ):
        self.client, self.rate, self.budget, self.attempts, self.sleep = client, rate, budget, attempts, sleep
        self.slot, self.of, self.clock = slot, of, clock
        self.origin = clock() if origin is None else origin
        self.spent, self.turn = 0, -1

    def wait(self) -> None:
        """Until this task's next slot: slot, slot + of, slot + 2 of, ... of the schedule. Slots gone by are lost."""
        now = self.clock()
        reached = math.ceil(((now - self.origin) * self.rate - self.slot) / self.of - 1e-9)
        self.turn = max(self.turn + 1, reached, 0)
        at = self.origin + (self.turn * self.of + self.slot) / self.rate
        if at > now:
            self.sleep(at - now)

    def call(self, name: str, *args):
        for attempt in range(self.attempts):
            if self.budget is not None and self.spent >= self.budget:
                raise BudgetSpent(f"{self.spent} requests")
            self.spent += 1
            self.wait()
            try:
                return getattr(self.client, name)(*args)
            except OSError:
                if attempt == self.attempts - 1:
                    raise
                if hasattr(self.client, "rotate"):
                    self.client.rotate()
                self.sleep(2**attempt / self.rate)


def pacer(options, part: Pages) -> Pacer:
    """The pacer of a partition: its slots, and its share of the budget; shares sum up to the budget."""
    budget = options.get("daily_budget")
    share = None if budget is None else int(budget) // part.of + (part.slot < int(budget) % part.of)
    rate = float(options.get("requests_per_second", 8))
    return Pacer(client_of(options["client"], options), rate, share, slot=part.slot, of=part.of, origin=part.origin)


def parallel(options) -> int:
    return int(options.get("parallel", PARALLEL))


def planned(options, query: str, want: int) -> list[Page]:
    year = int(options.get("last_year", time.gmtime().tm_year))
    client = client_of(options["client"], options)
    return split(
        client, query, want, year, int(options.get("first_year", 1950)), int(options.get("cap", CAP)), options.get("facets", FACETS), int(options.get("page_size", PAGE))
    )


class Reader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        o = self.options
        return dealt(planned(o, o["query"], int(o.get("max_results", 50_000))), parallel(o))

    def read(self, partition: Pages):
        calls = pacer(self.options, partition)
        for p in partition.pages:
            yield from ((str(x),) for x in calls.call("page", p.query, p.start, p.size))


class UpdatesReader(DataSourceStreamReader):
    """A stream of ids of records with a whole publication date, yyyy/mm/dd. An offset is the last day that has been read, so a query that is stopped and
    started again from its checkpoint asks for the days after it; a batch that is repeated asks for the same days."""

    def __init__(self, options):
        self.options = options

    def initialOffset(self):
        return {"day": self.options["after"]}

    def latestOffset(self):
        return {"day": client_of(self.options["client"], self.options).latest()}

    def partitions(self, start, end):
        if start["day"] >= end["day"]:
            return []
        o = self.options
        day = datetime.strptime(start["day"], "%Y/%m/%d") + timedelta(days=1)
        query = f"({o['query']}) AND {day:%Y/%m/%d}:{end['day']}[pdat]"
        return dealt(planned(o, query, int(o.get("max_results", 10**9))), parallel(o))

    def read(self, partition: Pages):
        return Reader(self.options).read(partition)

    def commit(self, end):
        return None


class CursorReader(DataSourceReader):
    """Pages follow one another by their marks, so one query is one partition. Ends at an empty page, a repeated mark, a
    missing page or ``max_results``."""

    def __init__(self, options):
        self.options = options

    def partitions(self):
        return dealt([Page(q, 0, 0) for q in self.options["query"].split("\n") if q.strip()], parallel(self.options))

    def read(self, partition: Pages):
        calls = pacer(self.options, partition)
        for p in partition.pages:
            yield from self.pages(calls, p.query)

    def pages(self, calls: Pacer, query: str):
        o = self.options
        want, mark, got = int(o.get("max_results", 5_000)), "*", 0
        while got < want:
            try:
                ids, after = calls.call("cursor", query, mark, int(o.get("page_size", 100)))
            except FileNotFoundError:
                return
            for x in ids[: want - got]:
                yield (str(x),)
            got += len(ids)
            if not ids or not after or after == mark:
                return
            mark = after


class WorksReader(DataSourceReader):
    """Batches of DOIs (option ``dois``, a|b|c). A refused batch is asked for one by one; what is refused then is left out."""

    def __init__(self, options):
        self.options = options

    def partitions(self):
        dois, size = [d for d in self.options["dois"].split("|") if d], int(self.options.get("batch", 50))
        return dealt([dois[i : i + size] for i in range(0, len(dois), size)], parallel(self.options))

    def read(self, partition: Pages):
        calls = pacer(self.options, partition)
        for dois in partition.pages:
            try:
                yield from calls.call("works", dois)
            except OSError:
                for d in dois:
                    try:
                        row = calls.call("work", d)
                    except OSError:
                        continue
                    if row is not None:
                        yield row


class CorpusSearch(DataSource):
    @classmethod
    def name(cls):
        return "corpus_search"

    def schema(self):
        return "pmid string"

    def reader(self, schema):
        return Reader(self.options)


class CorpusUpdates(DataSource):
    @classmethod
    def name(cls):
        return "corpus_updates"

    def schema(self):
        return "pmid string"

    def streamReader(self, schema):
        return UpdatesReader(self.options)


class CorpusCursor(DataSource):
    @classmethod
    def name(cls):
        return "corpus_cursor"

    def schema(self):
        return "id string"

    def reader(self, schema):
        return CursorReader(self.options)


class CorpusWorks(DataSource):
    @classmethod
    def name(cls):
        return "corpus_works"

    def schema(self):
        return "doi string, cited_by_count bigint, percentile double, fwci double, oa_url string"

    def reader(self, schema):
        return WorksReader(self.options)


def register(spark: SparkSession) -> None:
    for source in (CorpusSearch, CorpusUpdates, CorpusCursor, CorpusWorks):
        spark.dataSource.register(source)
