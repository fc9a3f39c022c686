"""Log search.

A log table has: log_group, log_stream, timestamp (ms), message, ingestion_time
(ms), sequence, event_id.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lumenloom.functions import json_paths
from lumenloom.functions.booleans import bound, every, leaf
from lumenloom.functions.timebuckets import millis_to_text
from lumenloom.session import shared_dir

ORDER = ["timestamp", "sequence", "event_id"]
LINE_OVERHEAD = 26  # fixed value: stored bytes added per event
DEFAULT_FIELDS = ["@timestamp", "@message"]


def in_time_range(df: DataFrame, start_ms: int | None, end_ms: int | None) -> DataFrame:
    """Both ends inclusive."""
    if start_ms is not None:
        df = df.where(F.col("timestamp") >= start_ms)
    if end_ms is not None:
        df = df.where(F.col("timestamp") <= end_ms)
    return df


def filter_logs(
    df: DataFrame,
    group: str,
    streams: list[str] | None = None,
    start_ms: int | None = None,
    end_ms: int | None = None,
    contains: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Events of a group in time order, optionally by stream and text; at most ``limit`` if one is asked for."""
    out = in_time_range(df.where(F.col("log_group") == group), start_ms, end_ms)
    if streams:
        out = out.where(F.col("log_stream").isin(streams))
    if contains and contains.strip():
        out = out.where(F.col("message").contains(contains))
    out = out.orderBy(*ORDER)
    return out if limit is None else out.limit(limit)


def log_stream_stats(df: DataFrame) -> DataFrame:
    """Per stream: first and last event, last ingestion, stored bytes."""
    size = F.octet_length(F.coalesce("message", F.lit(""))) + LINE_OVERHEAD
    return df.groupBy("log_group", "log_stream").agg(
        F.min("timestamp").alias("first_event"),
        F.max("timestamp").alias("last_event"),
        F.max("ingestion_time").alias("last_ingestion"),
        F.sum(size).alias("stored_bytes"),
    )


def log_page(
    df: DataFrame,
    n: int | None = None,
    from_head: bool = True,
    after: tuple | None = None,
    before: tuple | None = None,
    start_ms: int | None = None,
    end_ms: int | None = None,
) -> DataFrame:
    """One page of ``n`` events of a stream in time order; without n all there are.

    ``after`` and ``before`` are the (timestamp, sequence, event_id) of a page edge:
    a forward page starts past the one, a backward page ends ahead of the other.
    Keys instead of offsets keep a page to a range scan with a bounded top-n.
    """
    out = in_time_range(df, start_ms, end_ms)
    place = F.struct(*ORDER)
    if after is not None:
        out = out.where(place > _edge(after))
    if before is not None:
        out = out.where(place < _edge(before))
    forward = after is not None or (before is None and from_head)
    if forward or n is None:
        return out.orderBy(*ORDER) if n is None else out.orderBy(*ORDER).limit(n)
    return out.orderBy(*[F.desc(c) for c in ORDER]).limit(n).orderBy(*ORDER)


def _edge(values: tuple) -> Column:
    return F.struct(*[F.lit(v).alias(c) for v, c in zip(values, ORDER)])


SYSTEM_FIELDS = {
    "@timestamp": lambda: millis_to_text(F.col("timestamp")),
    "@ingestionTime": lambda: millis_to_text(F.col("ingestion_time")),
    "@message": lambda: F.col("message"),
    "@ptr": lambda: F.col("event_id"),
}


def field_text(name: str, message: Column | None = None) -> Column:
    """The text of a field: a system field, or a dotted path in the JSON message.

    ``message`` is the message if it is parsed already.
    """
    if name in SYSTEM_FIELDS:
        return SYSTEM_FIELDS[name]()
    steps = [s for s in name.split(".") if s]
    parsed = json_paths.parse(F.col("message")) if message is None else message
    return json_paths.at(parsed, steps, "string")


@dataclass(frozen=True)
class LogQuery:
    """Clauses of a search; each method returns a new query, ``run`` the rows.

    Whatever the order of the calls, a search filters, sorts, drops duplicates,
    limits and projects, in this order. A later sort replaces an earlier one.
    """

    logs: DataFrame
    tests: tuple = ()
    order: tuple[str, bool] | None = None
    unique: tuple[str, ...] = ()
    most: int | None = None
    shown: tuple[str, ...] = ()
    scanned: Observation | None = field(default=None, compare=False)

    def where_eq(self, name: str, value: str) -> LogQuery:
        return replace(self, tests=(*self.tests, (name, value, True)))

    def where_ne(self, name: str, value: str) -> LogQuery:
        """Keeps rows that lack the field."""
        return replace(self, tests=(*self.tests, (name, value, False)))

    def _passes(self, message: Column) -> Column:
        tests = []
        for name, value, equal in self.tests:
            test = leaf(field_text(name, message) == value)
            tests.append(test if equal else ~test)
        return every(tests)

    def sort(self, name: str, desc: bool = False) -> LogQuery:
        return replace(self, order=(name, desc))

    def dedup(self, *names: str) -> LogQuery:
        return replace(self, unique=names)

    def limit(self, n: int) -> LogQuery:
        return replace(self, most=n)

    def fields(self, *names: str) -> LogQuery:
        return replace(self, shown=(*self.shown, *names))

    def observe(self, observation: Observation) -> LogQuery:
        """Count the scanned rows while the search runs (``records_scanned``).

        Unless the search has a limit, ``run`` then writes what it found before sorting it.
        """
        return replace(self, scanned=observation)

    def _order_columns(self) -> list[Column]:
        """Total order of the result, as (key, descending) columns.

        Times sort as numbers and turn their tie-breakers with them; any other
        field sorts as text, a missing one as empty, ties in time order.
        """
        if self.order is None:
            desc = bool(self.unique)
            keys = [F.col(c) for c in ORDER]
        else:
            name, desc = self.order
            if name == "@timestamp":
                keys = [F.col(c) for c in ORDER]
            elif name == "@ingestionTime":
                keys = [F.col(c) for c in ("ingestion_time", "sequence", "event_id")]
            else:
                text = F.coalesce(field_text(name), F.lit(""))
                return [text.desc() if desc else text.asc(), *[F.col(c).asc() for c in ORDER]]
        return [k.desc() if desc else k.asc() for k in keys]

    def _by_text(self) -> bool:
        return self.order is not None and self.order[0] not in ("@timestamp", "@ingestionTime")

    def _first_per_tuple(self, rows: DataFrame) -> DataFrame:
        """The first row of each tuple in result order.

        Aggregates, not a window: they combine before the shuffle, so a tuple that
        holds most rows costs one row per input partition. A text order takes two
        steps, as its ties come in time order whatever its direction.
        """
        names = [f"_k{i}" for i in range(len(self.unique))]
        keys = [field_text(n).alias(k) for n, k in zip(self.unique, names)]
        whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
        desc = self.order[1] if self.order else True
        if not self._by_text():
            lead = "ingestion_time" if self.order and self.order[0] == "@ingestionTime" else "timestamp"
            rank = F.struct(lead, "sequence", "event_id").alias("_rank")
            first = F.max_by("_row", "_rank") if desc else F.min_by("_row", "_rank")
            picked = rows.select(*keys, whole, rank).groupBy(*names).agg(first.alias("_row"))
            return picked.select("_row.*")
        text = F.coalesce(field_text(self.order[0]), F.lit("")).alias("_text")
        per_text = (
            rows.select(*keys, text, whole, F.struct(*ORDER).alias("_rank"))
            .groupBy(*names, "_text")
            .agg(F.min_by("_row", "_rank").alias("_row"))
        )
        first = F.max_by("_row", "_text") if desc else F.min_by("_row", "_text")
        return per_text.groupBy(*names).agg(first.alias("_row")).select("_row.*")

    def run(self) -> DataFrame:
        rows = self.logs
        if self.scanned is not None:
            rows = rows.observe(self.scanned, F.count(F.lit(1)).alias("records_scanned"))
        if self.tests:
            # a message is parsed once for all tests; one that is no JSON has no fields
            rows = rows.where(bound(json_paths.parse(F.col("message")), self._passes))
        if self.unique:
            rows = self._first_per_tuple(rows)
        if self.scanned is not None and self.most is None:
            # a full sort reads its input twice, which would count twice
            path = shared_dir(rows.sparkSession, "found")
            rows.write.parquet(path)
            rows = rows.sparkSession.read.schema(rows.schema).parquet(path)
        rows = rows.orderBy(*self._order_columns())
        if self.most is not None:
            rows = rows.limit(self.most)
        names = list(dict.fromkeys(self.shown or DEFAULT_FIELDS))
        out = [F.coalesce(field_text(n), F.lit("")).alias(n) for n in names]
        if "@ptr" not in names:
            out.append(F.col("event_id").alias("@ptr"))
        return rows.select(out)


def log_query(
    df: DataFrame, groups: list[str], start_ms: int | None = None, end_ms: int | None = None
) -> LogQuery:
    """A search over some groups (repeats count once) in an inclusive time range."""
    groups = sorted({g for g in groups if g and g.strip()})
    if not groups:
        raise ValueError("name at least one log group")
    return LogQuery(in_time_range(df.where(F.col("log_group").isin(groups)), start_ms, end_ms))


def query_counters(query: LogQuery) -> DataFrame:
    """Records in the time range, and rows the search returns, as one row."""
    if query.unique:
        scanned = query.logs.agg(F.count("*").alias("records_scanned"))
        matched = query.run().agg(F.count("*").alias("records_matched"))
        both = scanned.withColumn("records_matched", F.lit(None).cast("long")).unionByName(
            matched.withColumn("records_scanned", F.lit(None).cast("long"))
        )
        return both.agg(F.max("records_scanned").alias("records_scanned"), F.max("records_matched").alias("records_matched"))
    # one scan: without duplicates to drop, a row that passes is a row returned
    passes = bound(json_paths.parse(F.col("message")), query._passes) if query.tests else F.lit(True)
    matched = F.count_if(passes)
    return query.logs.agg(
        F.count("*").alias("records_scanned"),
        (matched if query.most is None else F.least(matched, F.lit(query.most))).alias("records_matched"),
    )


def retain(df: DataFrame, ts: str, hours: float, now: Column) -> DataFrame:
    """Rows not older than the retention time."""
    oldest = now - F.make_dt_interval(hours=F.lit(0), mins=F.lit(0), secs=F.lit(hours * 3600))
    return df.where(F.col(ts) >= oldest)
