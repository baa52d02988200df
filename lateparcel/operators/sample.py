"""Deterministic sampling, splitting, folds and over-sampling.

Rows are ordered by a portable hash of their key, and every exact quota becomes one hash value:
the largest hash still inside.  Finding it takes a histogram of hash buckets and a look into the
single bucket where the quota ends; after that, rows are assigned by comparing their own hash,
without sorting or shuffling the table.  Rows that share a key stay on the same side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateparcel.functions import hash_below_fraction, portable_hash
from lateparcel.operators.checks import local_table, settle_small
from lateparcel.operators.many_classes import (
    EVERYTHING,
    QUOTAS,
    ROWS,
    class_sizes,
    limit_hashes,
    share,
    written,
)

HASH, STRATUM, PART = "__hash", "__stratum", "__part"
# Hex digits of the bucket: 4096 buckets keep the histogram small next to any big table.
BUCKET_DIGITS = 3
MOST_DIGITS = 10
# Most (class, bucket) counts that may visit the driver; beyond, 16 buckets per class are used, and
# where these are too many as well, counts and quotas stay in DataFrames.
MOST_BUCKETS = 1_000_000
# A bucket with more rows than this is cut again before its rows are ordered.
BUCKET_ROWS = 2_000_000
# Copies of a row unfold in pieces of this many.
COPIES_AT_ONCE = 10_000


def _hashed(frame: DataFrame, keys: Sequence[str], seed: int, stratum: str | None) -> DataFrame:
    """Hash and stratum per row, with copies of a key already counted together."""
    label = F.lit("") if stratum is None else F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    return frame.select(label.alias(STRATUM), portable_hash(keys, seed).alias(HASH))


Buckets = dict[str, list[tuple[str, int]]]


def _bucket_counts(hashed: DataFrame, digits: int) -> Buckets | None:
    """Rows per class and hash bucket in hash order, or None when there are too many."""
    counted = hashed.groupBy(STRATUM, F.substring(HASH, 1, digits).alias("bucket")).agg(
        F.count("*").alias("n")
    )
    fetched = counted.limit(MOST_BUCKETS + 1).toArrow()
    if fetched.num_rows > MOST_BUCKETS:
        return None
    found: Buckets = {}
    for row in sorted(zip(*(fetched[c].to_pylist() for c in (STRATUM, "bucket", "n")))):
        found.setdefault(row[0], []).append(row[1:])
    return found


def allocate(counts: Mapping[str, int], draws: int) -> dict[str, int]:
    """Share ``draws`` over classes in proportion, largest remainders first, ties by name."""
    total = sum(counts.values())
    given = {name: draws * n // total for name, n in counts.items()}
    rest = {name: draws * n % total for name, n in counts.items()}
    left = draws - sum(given.values())
    for name in sorted(counts, key=lambda c: (-rest[c], c))[:left]:
        given[name] += 1
    return given


@dataclass(frozen=True)
class End:
    """The bucket in which a quota ends: rows before it, rows in it and what is asked for."""

    label: str
    position: int
    quota: int
    bucket: str
    before: int
    rows: int


def _end(label: str, position: int, quota: int, before: int, buckets) -> End:
    for bucket, n in buckets:
        if quota <= before + n:
            return End(label, position, quota, bucket, before, n)
        before += n
    raise ValueError("quota beyond the rows of its class")


def _inside(hashed: DataFrame, ends: Sequence[End], digits: int) -> DataFrame:
    """Rows of the buckets in which a quota ends."""
    pairs = sorted({(end.label, end.bucket) for end in ends})
    table = local_table(
        hashed.sparkSession,
        {STRATUM: [p[0] for p in pairs], "bucket": [p[1] for p in pairs]},
        f"{STRATUM} string, bucket string",
    )
    return hashed.withColumn("bucket", F.substring(HASH, 1, digits)).join(
        table, [STRATUM, "bucket"], "left_semi"
    )


def _refined(hashed: DataFrame, ends: Sequence[End], digits: int) -> list[End]:
    """The same quotas located in buckets of three more digits."""
    finer = (
        _inside(hashed, ends, digits)
        .groupBy(STRATUM, F.substring(HASH, 1, digits + BUCKET_DIGITS).alias("finer"))
        .agg(F.count("*").alias("n"))
        .collect()
    )
    parts: dict[tuple[str, str], list] = {}
    for row in sorted(finer):
        parts.setdefault((row[STRATUM], row["finer"][:digits]), []).append((row["finer"], row["n"]))
    return [
        _end(e.label, e.position, e.quota, e.before, parts[(e.label, e.bucket)]) for e in ends
    ]


def _hash_limits(
    hashed: DataFrame,
    buckets: Buckets,
    digits: int,
    counts: Mapping[str, int],
    quotas: Mapping[str, Sequence[int]],
    bucket_rows: int,
) -> dict[str, list[str]]:
    """For every class and quota the largest hash among the first ``quota`` rows in hash order."""
    limits = {
        label: [EVERYTHING if q >= counts[label] else "" for q in qs]
        for label, qs in quotas.items()
    }
    ends = [
        _end(label, position, quota, 0, buckets[label])
        for label, qs in quotas.items()
        for position, quota in enumerate(qs)
        if 0 < quota < counts[label]
    ]
    if not ends:
        return limits
    # a bucket that is still large is cut into finer buckets; copies of one key cannot be cut,
    # but they collapse to one row below
    while digits < MOST_DIGITS and max(end.rows for end in ends) > bucket_rows:
        ends = _refined(hashed, ends, digits)
        digits += BUCKET_DIGITS
    values = (
        _inside(hashed, ends, digits)
        .groupBy(STRATUM, "bucket", HASH)
        .agg(F.count("*").alias("copies"))
    )
    ordered = Window.partitionBy(STRATUM, "bucket").orderBy(HASH)
    wanted = local_table(
        hashed.sparkSession,
        {
            STRATUM: [e.label for e in ends],
            "bucket": [e.bucket for e in ends],
            "position": [e.position for e in ends],
            "place": [e.quota - e.before for e in ends],
        },
        f"{STRATUM} string, bucket string, position int, place bigint",
    )
    found = (
        values.withColumn(
            "upto", F.sum("copies").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
        )
        .join(wanted, [STRATUM, "bucket"])
        .where(F.col("upto") >= F.col("place"))
        .groupBy(STRATUM, "position")
        .agg(F.min(HASH).alias("limit"))
    )
    for row in found.collect():
        limits[row[STRATUM]][row["position"]] = row["limit"]
    return limits


def _stratify(counts: Mapping[str, int]) -> bool:
    """Stratify only with two or more classes of at least two rows each."""
    return len(counts) > 1 and min(counts.values()) >= 2


def cut_by_hash(
    frame: DataFrame,
    keys: Sequence[str],
    quotas: Callable[[dict[str, int]], Mapping[str, Sequence[int]]],
    stratum: str | None = None,
    seed: int = 42,
    only_if_usable: bool = True,
    bucket_rows: int = BUCKET_ROWS,
    wide_quotas: Callable[[DataFrame, int], DataFrame] | None = None,
) -> DataFrame:
    """Add ``__part``: 0 for rows up to the first quota of their class, 1 up to the second, …

    ``quotas`` turns class sizes into ascending row counts per class.  ``wide_quotas`` does the
    same for more classes than may visit the driver: from a frame of class sizes and the sum of
    rows to that frame with an array of quotas.  Classes too small to stratify are ignored when
    ``only_if_usable`` is set.
    """
    hashed = _hashed(frame, keys, seed, stratum)
    digits = BUCKET_DIGITS
    buckets = _bucket_counts(hashed, digits)
    if buckets is None:
        digits = 1
        buckets = _bucket_counts(hashed, digits)
    if buckets is None:
        if wide_quotas is None:
            raise ValueError(f"{stratum} has too many distinct values for quotas of the driver")
        classes = class_sizes(hashed)
        smallest, rows = classes.agg(F.min(ROWS), F.sum(ROWS)).head()
        if only_if_usable and smallest < 2:
            return cut_by_hash(frame, keys, quotas, None, seed, bucket_rows=bucket_rows)
        limits = limit_hashes(
            hashed, wide_quotas(classes, rows), BUCKET_DIGITS, MOST_DIGITS, bucket_rows
        )
        return _assign_from(frame, keys, seed, stratum, written(limits))
    counts = {label: sum(n for _, n in parts) for label, parts in buckets.items()}
    if stratum is not None and only_if_usable and not _stratify(counts):
        return cut_by_hash(frame, keys, quotas, None, seed, bucket_rows=bucket_rows)
    if not counts:
        return frame.withColumn(PART, F.lit(0))
    limits = _hash_limits(hashed, buckets, digits, counts, quotas(counts), bucket_rows)
    return _assign(frame, keys, seed, stratum, limits)


def _assign(frame, keys, seed, stratum, limits):
    """Compare each row's hash with the limits of its class."""
    hashed = portable_hash(keys, seed)

    def part(cuts: Sequence[str]) -> Column:
        place = F.lit(len(cuts))
        for position in reversed(range(len(cuts))):
            place = F.when(hashed <= F.lit(cuts[position]), F.lit(position)).otherwise(place)
        return place

    if stratum is None:
        return frame.withColumn(PART, part(limits.get("", [])))
    label = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    if len(limits) <= 16:
        place = F.lit(0)
        for name, cuts in limits.items():
            place = F.when(label == F.lit(name), part(cuts)).otherwise(place)
        return frame.withColumn(PART, place)
    table = local_table(
        frame.sparkSession,
        {STRATUM: list(limits), "__limits": list(limits.values())},
        f"{STRATUM} string, __limits array<string>",
    )
    return _assign_from(frame, keys, seed, stratum, table)


def _assign_from(frame, keys, seed, stratum, table):
    """The same by a join with the table of (class, limits)."""
    label = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    hashed = portable_hash(keys, seed)
    joined = frame.withColumn(STRATUM, label).withColumn(HASH, hashed).join(table, STRATUM, "left")
    below = F.filter("__limits", lambda cut: cut < F.col(HASH))
    return joined.withColumn(PART, F.size(below)).drop(STRATUM, HASH, "__limits")


def row_cap(frame: DataFrame, keys: Sequence[str], rows: int, seed: int = 42) -> DataFrame:
    """At most ``rows`` rows, the first in hash order; smaller tables pass unchanged."""
    marked = cut_by_hash(frame, keys, lambda counts: {c: [rows] for c in counts}, None, seed)
    return marked.where(F.col(PART) == 0).drop(PART)


def fraction_sample(
    frame: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42
) -> DataFrame:
    """About ``fraction`` of the rows; a fraction outside (0, 1) means all of them."""
    if not 0 < fraction < 1:
        return frame
    return frame.where(hash_below_fraction(portable_hash(keys, seed), fraction))


def stratified_cap(
    frame: DataFrame, keys: Sequence[str], label: str, rows: int, seed: int = 42
) -> DataFrame:
    """Down to ``rows`` rows with the class shares kept, or plainly if a class is too small."""
    def quotas(counts):
        if sum(counts.values()) <= rows:
            return {c: [n] for c, n in counts.items()}
        return {c: [q] for c, q in allocate(counts, rows).items()}

    def wide(classes, total):
        if total <= rows:
            return classes.withColumn(QUOTAS, F.array(ROWS))
        return share(classes, ROWS, rows, "__q").withColumn(QUOTAS, F.array("__q"))

    marked = cut_by_hash(frame, keys, quotas, label, seed, wide_quotas=wide)
    return marked.where(F.col(PART) == 0).drop(PART)


def _named(frame: DataFrame, names: Sequence[str], column: str) -> DataFrame:
    place = F.lit(names[-1])
    for position in reversed(range(len(names) - 1)):
        place = F.when(F.col(PART) == position, F.lit(names[position])).otherwise(place)
    return frame.withColumn(column, place).drop(PART)


def train_test_split(
    frame: DataFrame,
    keys: Sequence[str],
    test_size: float = 0.2,
    label: str | None = None,
    seed: int = 42,
    column: str = "split",
) -> DataFrame:
    """Add ``split`` = test for exactly ceil(n * test_size) rows, else train.

    With a label the test rows are shared over the classes in proportion.
    """
    def quotas(counts):
        test = math.ceil(sum(counts.values()) * test_size)
        return {c: [q] for c, q in allocate(counts, test).items()}

    def wide(classes, total):
        test = math.ceil(total * test_size)
        return share(classes, ROWS, test, "__q").withColumn(QUOTAS, F.array("__q"))

    marked = cut_by_hash(frame, keys, quotas, label, seed, wide_quotas=wide)
    return _named(marked, ["test", "train"], column)


def three_way_split(
    frame: DataFrame,
    keys: Sequence[str],
    test_size: float = 0.2,
    validation_size: float = 0.2,
    label: str | None = None,
    seed: int = 42,
    column: str = "split",
) -> DataFrame:
    """Test first, then a validation share of the rest; three ranges of one hash order."""
    def quotas(counts):
        total = sum(counts.values())
        test = math.ceil(total * test_size)
        validation = math.ceil((total - test) * validation_size)
        first = allocate(counts, test)
        rest = {c: n - first[c] for c, n in counts.items()}
        second = allocate(rest, validation)
        return {c: [first[c], first[c] + second[c]] for c in counts}

    def wide(classes, total):
        test = math.ceil(total * test_size)
        validation = math.ceil((total - test) * validation_size)
        first = share(classes, ROWS, test, "__q").withColumn("__left", F.col(ROWS) - F.col("__q"))
        second = share(first, "__left", validation, "__r")
        return second.withColumn(QUOTAS, F.array(F.col("__q"), F.col("__q") + F.col("__r")))

    marked = cut_by_hash(frame, keys, quotas, label, seed, wide_quotas=wide)
    return _named(marked, ["test", "validation", "train"], column)


def assign_folds(
    frame: DataFrame,
    keys: Sequence[str],
    folds: int = 3,
    label: str | None = None,
    seed: int = 42,
    column: str = "fold",
) -> DataFrame:
    """Add a fold number; fold sizes differ by at most one row within each class."""
    def quotas(counts):
        cuts = {}
        for name, n in counts.items():
            sizes = [n // folds + (1 if f < n % folds else 0) for f in range(folds)]
            cuts[name] = [sum(sizes[: f + 1]) for f in range(folds - 1)]
        return cuts

    def wide(classes, total):
        # the first f + 1 folds hold that many n-ths and at most one more row each
        ends = [
            F.floor(F.col(ROWS) / folds) * (f + 1) + F.least(F.lit(f + 1), F.col(ROWS) % folds)
            for f in range(folds - 1)
        ]
        return classes.withColumn(QUOTAS, F.array(*ends).cast("array<bigint>"))

    marked = cut_by_hash(
        frame, keys, quotas, label, seed, only_if_usable=False, wide_quotas=wide
    )
    return marked.withColumnRenamed(PART, column)


def oversample(
    frame: DataFrame,
    keys: Sequence[str],
    label: str,
    threshold: float = 0.8,
    seed: int = 42,
) -> DataFrame:
    """Repeat rows of smaller classes until every class is as large as the largest.

    Every row of a class is repeated equally often, and the first rows in hash order once more
    to make up the difference.  Nothing happens when the smallest class is at least
    ``threshold`` of the largest.  ``copy`` numbers the copies of a row from 1.
    """
    smallest = largest = 0
    repeats = None

    def quotas(counts):
        nonlocal smallest, largest, repeats
        smallest, largest = min(counts.values()), max(counts.values())
        repeats = local_table(
            frame.sparkSession,
            {STRATUM: list(counts), "__each": [largest // n for n in counts.values()]},
            f"{STRATUM} string, __each bigint",
        )
        return {c: [largest % n] for c, n in counts.items()}

    def wide(classes, total):
        nonlocal smallest, largest, repeats
        smallest, largest = classes.agg(F.min(ROWS), F.max(ROWS)).head()
        repeats = classes.select(STRATUM, F.expr(f"{largest}L div {ROWS}").alias("__each"))
        return classes.withColumn(QUOTAS, F.array(F.lit(largest).cast("bigint") % F.col(ROWS)))

    marked = cut_by_hash(
        frame, keys, quotas, label, seed, only_if_usable=False, wide_quotas=wide
    )
    if not largest or smallest / largest >= threshold:
        return marked.drop(PART).withColumn("copy", F.lit(1))
    name = F.coalesce(F.col(label).cast("string"), F.lit(""))
    marked = marked.withColumn(STRATUM, name).join(repeats, STRATUM).drop(STRATUM)
    times = F.col("__each") + F.when(F.col(PART) == 0, F.lit(1)).otherwise(F.lit(0))
    times = times.cast("bigint")
    piece = F.lit(COPIES_AT_ONCE)
    pieces = marked.withColumn("__times", times).withColumn(
        "__piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("__times") - 1) / piece)))
    )
    if largest // smallest >= COPIES_AT_ONCE:
        # few rows with very many copies: spread the pieces over the tasks first
        pieces = pieces.repartition(*keys, "__piece")
    first = F.col("__piece") * piece + 1
    last = F.least(F.col("__times"), (F.col("__piece") + 1) * piece)
    return (
        pieces.withColumn("copy", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
        .drop(PART, "__each", "__times", "__piece")
    )


def shuffle_order(frame: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Rows in hash order; rows in a frame have no order, so the hash stays as a column."""
    return frame.withColumn("shuffle_key", portable_hash(keys, seed)).orderBy("shuffle_key")


def balanced_weights(frame: DataFrame, label: str, column: str = "weight") -> DataFrame:
    """Weight n / (classes * rows of the class) per row; rows without a label are a class too."""
    counts = settle_small(frame.groupBy(label).agg(F.count("*").alias("__n")))
    totals = counts.agg(F.sum("__n").alias("rows"), F.count("*").alias("classes"))
    weights = counts.select(
        F.col(label).alias(STRATUM),
        (
            totals.select("rows").scalar()
            / (totals.select("classes").scalar() * F.col("__n"))
        ).alias(column),
    )
    return frame.join(weights, F.col(label).eqNullSafe(F.col(STRATUM))).drop(STRATUM)
