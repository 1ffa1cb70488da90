"""The marketplace listing as a maintained read model: clustered for every sort order, counted, and indexed for keywords.

Every sort column has its own copy of the rows, in ranges of its values (missing values are a range of their own). A page starts at its
cursor's range and takes one more range, two more, four more until it is full, so it opens the files of a few ranges, however long
the listing is. Changed rows rewrite the ranges that they leave and enter, and nothing else. A long listing is written by the tasks that
read it, a file per task and range, so it is not shuffled for an order; a short one would lie in very small files and is dealt.

Counts lie in a cube by day. A request that the cube knows is summed from it, but for the one day that the clock divides.

A keyword is looked up in posting lists: for each run of three characters the ranges of one order in which a listing holds it. Lists
are intersected, and the rows of the ranges that survive are checked against the text, so the answer is the scan's. Lists of single
listings would be several times the listing; these grow with the distinct runs. A keyword of runs that are common everywhere opens every range.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import instant
from ..functions.text import safe_search_term
from ..schemas import ENDED_STATUSES
from ..session import stored
from . import versioned
from .filters import Filters, apply_filters, is_scrap, keyword_matches, keyword_matches_loosely, loose_text, squeezed
from .paging import SORTS, after, clamp_limit, decode_cursor, sort_order

c = F.col
CLUSTERS = sorted({column for column, _ in SORTS.values()})
RANGES, GRAM = 64, 3
#: Rows from which on a listing is not dealt to its ranges: tasks that read 128 MB then write thousands of rows a file.
LONG = 5_000_000
MISSING = "missing"
#: What the cube counts by.
CUBE = ["day", "scrap", "ended_status", "vehicle_type"]


# --- clustered rows ----------------------------------------------------------------------------------
def _bounds(listing: DataFrame, ranges: int) -> dict[str, list[float]]:
    """Values that part each sort column into ranges of about one size, found in one pass."""
    numbers = listing.select(*[_number(listing, n).alias(n) for n in CLUSTERS])
    found = numbers.approxQuantile(CLUSTERS, [k / ranges for k in range(1, ranges)], 0.5 / ranges)
    return {n: sorted(set(values)) for n, values in zip(CLUSTERS, found, strict=True)}


def _number(listing: DataFrame, column: str) -> Column:
    value = c(column)
    return (F.unix_micros(value.cast("timestamp")) if listing.schema[column].dataType.typeName().startswith("timestamp") else value).cast("double")


def _range_of(listing: DataFrame, column: str, bounds: list[float]) -> Column:
    number = _number(listing, column)
    place = F.aggregate(F.array(*[F.lit(b) for b in bounds]), F.lit(0), lambda n, b: n + (number >= b).cast("int")) if bounds else F.lit(0)
    return F.when(number.isNull(), F.lit(MISSING)).otherwise(F.lpad(place.cast("string"), 6, "0"))


def write_model(spark: SparkSession, listing: DataFrame, path: str, ranges: int = RANGES) -> None:
    """Build the read model of a listing."""
    bounds = _bounds(listing, ranges)
    tasks = _tasks(listing.count())
    spark.createDataFrame([(json.dumps(bounds),)], "bounds string").coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds")
    for column in CLUSTERS:
        versioned.append_rows(spark, f"{path}/{column}", listing.withColumn("bucket", _range_of(listing, column, bounds[column])), ["id"], tasks=tasks)
    versioned.append_rows(spark, f"{path}/cube", _cube(versioned.read_buckets(spark, f"{path}/auction_at")), CUBE)
    _add_postings(spark, listing, path, bounds)


def _tasks(number: int) -> int | None:
    return 1 if number < LONG else None


def _read_bounds(spark: SparkSession, path: str) -> dict[str, list[float]]:
    return json.loads(spark.read.parquet(f"{path}/bounds").first()[0])


def refresh(spark: SparkSession, changed: DataFrame, path: str, removed: DataFrame | None = None, keep: int = 2) -> dict[str, list[str]]:
    """Bring changed rows (whole) into the model and take removed ids out; the ranges of each order that were rewritten.

    Of the stored listing the ids and the sort columns are read, to find the ranges that hold the old rows. Of each order ``keep`` versions
    stay: 1, if nobody reads the one before.
    """
    bounds = _read_bounds(spark, path)
    gone = changed.select("id") if removed is None else changed.select("id").union(removed.select("id"))
    old = rows(spark, path).select("id", *CLUSTERS).join(gone.distinct(), "id", "left_semi")
    old = stored(old.select("id", *[_range_of(old, n, bounds[n]).alias(n) for n in CLUSTERS]))
    new = changed.select(*[_range_of(changed, n, bounds[n]).alias(n) for n in CLUSTERS])
    # the names of ranges, which are a few dozen per order
    touched = {n: sorted(x for x in row if x is not None) for n, row in old.select(*CLUSTERS).union(new).agg(*[F.collect_set(n).alias(n) for n in CLUSTERS]).first().asDict().items()}
    tasks = _tasks(rows(spark, path).count())
    for column, due in touched.items():
        fresh = changed.withColumn("bucket", _range_of(changed, column, bounds[column]))
        leaving = old.select("id", c(column).alias("bucket"))
        _replace(spark, f"{path}/{column}", due, lambda kept, fresh=fresh, leaving=leaving: _without(kept, leaving).select(fresh.columns).unionByName(fresh), fresh, tasks)
        versioned.vacuum(spark, f"{path}/{column}", keep)
    if due := touched["auction_at"]:
        counted = _cube(versioned.read_buckets(spark, f"{path}/auction_at", due))
        _replace(spark, f"{path}/cube", due, lambda _: counted, counted)
    _add_postings(spark, changed, path, bounds)
    return touched


#: Ids that are sent to every task at once.
SENT_IDS = 500_000


def _without(kept: DataFrame, leaving: DataFrame, most: int = SENT_IDS) -> DataFrame:
    """Rows of some ranges but those that leave them (``id``, ``bucket``). Ids are looked up range by range, at most ``most`` at once, where the
    rows are read; a range that more ids leave is joined as Spark sees fit."""
    counts = {r["bucket"]: r["count"] for r in leaving.groupBy("bucket").count().collect()}  # a few dozen ranges
    groups: list[tuple[int, list[str]]] = []
    for bucket, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        if groups and groups[-1][0] + n <= most:
            groups[-1] = (groups[-1][0] + n, [*groups[-1][1], bucket])
        else:
            groups.append((n, [bucket]))
    parts = [] if not counts else [kept.filter(~c("bucket").isin(list(counts)))]
    for n, names in groups:
        ids = leaving.filter(c("bucket").isin(names)).select("id")
        parts.append(kept.filter(c("bucket").isin(names)).join(F.broadcast(ids) if n <= most else ids, "id", "left_anti").select(kept.columns))
    return reduce(DataFrame.unionByName, parts) if parts else kept


def _replace(spark: SparkSession, path: str, due: list[str], change, added: DataFrame, tasks: int | None = 1) -> None:
    if set(due) & set(versioned.buckets_of(versioned.manifest(spark, path))):
        versioned.rewrite(spark, path, due, change, tasks)
    elif due:
        versioned.append_rows(spark, path, added, ["id"] if "id" in added.columns else CUBE, tasks=tasks)


def rows(spark: SparkSession, path: str, column: str = CLUSTERS[0], ranges: list[str] | None = None) -> DataFrame:
    """The listing, clustered by a column; of some of its ranges only, if they are named."""
    return versioned.read_buckets(spark, f"{path}/{column}", ranges).drop("bucket")


def page_rows(spark: SparkSession, path: str, filters: Filters, as_of, sort: str = "auction_asc", limit: int | None = None,
              cursor: str | None = None, favorites: DataFrame | None = None) -> DataFrame:
    """A page and one row more, from as few ranges as fill it."""
    column, ascending = SORTS[sort]
    found = versioned.buckets_of(versioned.manifest(spark, f"{path}/{column}"))
    order = sorted((b for b in found if b != MISSING), reverse=not ascending) + [b for b in found if b == MISSING]
    position = decode_cursor(cursor)
    position = position if position and position["sort"] == sort else None
    if position:
        whole = rows(spark, path, column, order[:1])
        if position["value"] is None:
            start = MISSING
        else:
            mark = F.lit(position["value"]).cast(whole.schema[column].dataType)
            one = spark.range(1).select(mark.alias(column))
            start = one.select(_range_of(one, column, _read_bounds(spark, path)[column])).first()[0]
        ahead = (lambda b: b == MISSING or (b >= start if ascending else b <= start)) if start != MISSING else (lambda b: b == MISSING)
        order = [b for b in order if ahead(b)]
    size, taken, step = clamp_limit(limit) + 1, 0, 1
    while True:
        taken = min(len(order), taken + step)
        some = apply_filters(rows(spark, path, column, order[:taken]), filters, as_of, favorites)
        if position:
            some = after(some, sort, position["value"], position["id"])
        some = some.orderBy(*sort_order(sort)).limit(size)
        if taken == len(order) or some.count() == size:
            return some
        step *= 2


# --- counts ------------------------------------------------------------------------------------------
def _cube(listing: DataFrame) -> DataFrame:
    """Counts of the rows of each range of deadlines."""
    ended = F.coalesce(c("auction_status").isin(ENDED_STATUSES), F.lit(False))
    return listing.groupBy("bucket", F.to_date("auction_at").alias("day"), is_scrap().alias("scrap"), ended.alias("ended_status"), "vehicle_type").agg(
        F.count(F.lit(1)).alias("n"))


def count(spark: SparkSession, path: str, filters: Filters, as_of, favorites: DataFrame | None = None) -> DataFrame:
    """How many rows a request selects (``total``): from the cube if it knows the filters, else from the rows."""
    plain = Filters(market_view=filters.market_view, sort=filters.sort, vehicle_type=filters.vehicle_type)
    if filters != plain or filters.market_view == "favorites":
        return apply_filters(rows(spark, path), filters, as_of, favorites).agg(F.count(F.lit(1)).alias("total"))
    view, today = filters.market_view, F.to_date(instant(as_of))
    cube = versioned.read_buckets(spark, f"{path}/cube")
    divided = [r["bucket"] for r in cube.filter(c("day") == today).select("bucket").distinct().collect()]
    whole = cube.filter(c("day").isNull() | (c("day") != today)).filter(c("scrap") if view == "scrap" else ~c("scrap"))
    ended = c("ended_status") | F.coalesce(c("day") < today, F.lit(False))
    if view in ("active", "ended"):
        whole = whole.filter(ended if view == "ended" else ~ended)
    if filters.vehicle_type:
        whole = whole.filter(c("vehicle_type") == filters.vehicle_type)
    part = whole.select("n")
    if divided:
        part = part.union(apply_filters(rows(spark, path, "auction_at", divided).filter(F.to_date("auction_at") == today), filters, as_of).select(F.lit(1).cast("long")))
    return part.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))


# --- keywords ----------------------------------------------------------------------------------------
EXACT, LOOSE = "exact", "loose"
PLACES = CLUSTERS[0]
POSTING_BUCKETS = 64


POSTINGS = "place string, kind string, gram string"
#: Characters that are cut into runs at once, and runs that a task holds before it hands them on.
CUT_CHARS, HELD_RUNS = 1 << 20, 2 << 20


def _runs_of(texts: list[str], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (run, place) of some texts; a run is GRAM characters of 21 bits."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if len(codes) < GRAM:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    last = len(codes) - GRAM + 1
    runs = reduce(lambda run, k: run << 21 | codes[k : last + k], range(1, GRAM), codes[:last])
    inside = owner[:last] == owner[GRAM - 1 :]  # not across two texts
    return _distinct(runs[inside], places[owner[:last][inside]])


def _distinct(runs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(runs):
        return runs, places
    number, known = pd.factorize(runs)
    width = int(places.max()) + 1
    pairs = pd.unique(number * width + places)
    return known[pairs // width], pairs % width


def _as_text(runs: np.ndarray) -> list[str]:
    codes = np.stack([runs >> 21 * (GRAM - 1 - k) & 0x1FFFFF for k in range(GRAM)], axis=1).astype(np.uint32)
    whole = codes.tobytes().decode("utf-32-le", "surrogatepass")
    return [whole[i : i + GRAM] for i in range(0, len(whole), GRAM)]


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, kind, gram) of the rows' texts, each at least once; what comes again in a task is mostly left out."""
    names: dict[str, int] = {}
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {EXACT: [], LOOSE: []}
    size = dict.fromkeys(held, 0)

    def merged(kind: str) -> None:
        held[kind] = [_distinct(*(np.concatenate(x) for x in zip(*held[kind], strict=True)))] if held[kind] else []
        size[kind] = sum(len(runs) for runs, _ in held[kind])

    def handed_on(kind: str) -> Iterator[pa.RecordBatch]:
        known = list(names)
        for runs, places in held[kind]:
            for i in range(0, len(runs), 100_000):
                found = _as_text(runs[i : i + 100_000])
                where = [known[p] for p in places[i : i + 100_000]]
                yield pa.RecordBatch.from_arrays([pa.array(where, pa.string()), pa.array([kind] * len(found), pa.string()), pa.array(found, pa.string())], ["place", "kind", "gram"])
        held[kind], size[kind] = [], 0

    for batch in batches:
        places = np.fromiter((names.setdefault(p, len(names)) for p in batch.column("place").to_pylist()), np.int64, batch.num_rows)
        for kind in held:
            texts = [t or "" for t in batch.column(kind).to_pylist()]
            start, chars = 0, 0
            for i, text in enumerate(texts):
                chars += len(text)
                if chars >= CUT_CHARS or i == len(texts) - 1:
                    held[kind].append(_runs_of(texts[start : i + 1], places[start : i + 1]))
                    size[kind] += len(held[kind][-1][0])
                    start, chars = i + 1, 0
            if size[kind] > HELD_RUNS:
                merged(kind)
                if size[kind] > HELD_RUNS // 2:
                    yield from handed_on(kind)
    for kind in held:
        merged(kind)
        yield from handed_on(kind)


def _add_postings(spark: SparkSession, listing: DataFrame, path: str, bounds: dict[str, list[float]]) -> None:
    """Append the ranges that hold the rows' runs. What a changed row was found by before stays, and is sorted out when it is read."""
    named = listing.withColumns({"name": F.concat_ws(" ", "brand_name", "model_name"), "place": _range_of(listing, PLACES, bounds[PLACES])})
    texts = named.select("place", c("search_text").alias(EXACT), loose_text().alias(LOOSE))
    # combined before the shuffle: what moves is runs, not listings
    postings = texts.mapInArrow(_runs, POSTINGS).distinct()
    bucket = versioned.bucket_of(["kind", "gram"], POSTING_BUCKETS)
    versioned.append_rows(spark, f"{path}/postings", postings.withColumn("bucket", bucket), ["kind", "gram", "place"], sort=["kind", "gram", "place"])


def _term(spark: SparkSession, keyword: str, kind: str) -> str:
    plain = F.lower(safe_search_term(F.lit(keyword))) if kind == EXACT else squeezed(F.lower(F.trim(F.lit(keyword))))
    return spark.range(1).select(plain).first()[0]


def keyword_rows(spark: SparkSession, path: str, keyword: str, loose: bool = False) -> DataFrame:
    """All listings that hold the keyword. A keyword of fewer than GRAM characters is looked for in every row."""
    kind = LOOSE if loose else EXACT
    term = _term(spark, keyword, kind)
    check = keyword_matches_loosely(keyword) if loose else keyword_matches(keyword)
    grams = sorted({term[i : i + GRAM] for i in range(len(term) - GRAM + 1)})
    whole = lambda found: found.withColumn("name", F.concat_ws(" ", "brand_name", "model_name")).filter(check).drop("name")
    if not grams:
        return whole(rows(spark, path))
    wanted = spark.createDataFrame([(kind, g) for g in grams], "kind string, gram string")
    buckets = [r[0] for r in wanted.select(versioned.bucket_of(["kind", "gram"], POSTING_BUCKETS)).distinct().collect()]
    lists = versioned.read_buckets(spark, f"{path}/postings", buckets, merge=False).filter((c("kind") == kind) & c("gram").isin(grams))
    found = lists.groupBy("place").agg(F.count_distinct("gram").alias("n")).filter(c("n") == len(grams))
    return whole(rows(spark, path, PLACES, [r["place"] for r in found.collect()]))  # ranges of one order
