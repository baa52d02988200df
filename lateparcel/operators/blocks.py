"""Training rows as blocks of numbers, and fits of many models in the same passes.

A block is one row of the frame with some thousand training rows as arrays. A pass is one Spark job
over the blocks that serves every model at once: each fold and each setting of a search is a *run*,
which leaves out the rows of its own fold. Passes read the kept blocks, never the source again; a
lost block is made anew from the training frame.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Training rows of one block.
BLOCK_ROWS = 4096
#: Bytes of sums that the partitions of a pass may send to the driver.
TOLD_BYTES = 64_000_000
#: The run that leaves out no fold.
WHOLE = -1

_BLOCK = "block long, rows int, x binary, label binary, weight binary, fold binary, copies binary"


@dataclass
class Block:
    """Arrays of some training rows; ``x`` has one row of features each.

    A row stands for ``count`` equal ones, and ``weight`` is the weight of all of them.
    """

    number: int
    x: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    fold: np.ndarray
    count: np.ndarray

    def kept(self, fold: int) -> np.ndarray:
        """Rows that a run without this fold sees."""
        return self.fold != fold


def read_block(row) -> Block:
    label = np.frombuffer(row.label)
    return Block(
        row.block,
        np.frombuffer(row.x).reshape(len(label), -1),
        label,
        np.frombuffer(row.weight),
        np.frombuffer(row.fold, np.int32),
        np.frombuffer(row.copies),
    )


def blocks_of(train: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of a frame with ``features`` and ``label``, kept for the passes that follow.

    ``weight`` is one and ``fold`` is 0 where the frame has none. Equal rows of a fold become one with
    their number, so that passes grow with the different rows only; they are sorted to repeat a fit.
    """
    has = set(train.columns)
    rows = train.select(
        vector_to_array("features").alias("x"),
        F.col("label").cast("double").alias("label"),
        (F.col("weight") if "weight" in has else F.lit(1.0)).cast("double").alias("weight"),
        (F.col("fold") if "fold" in has else F.lit(0)).cast("int").alias("fold"),
    )
    keys = ["x", "label", "weight", "fold"]
    merged = rows.groupBy(*keys).agg(F.count("*").cast("double").alias("copies")).sortWithinPartitions(*keys)
    merged = merged.withColumn("weight", F.col("weight") * F.col("copies"))
    return gathered(merged, lambda x: np.stack(x).astype(float).tobytes(), block_rows)


def gathered(rows: DataFrame, pack: Callable, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Kept blocks of rows of x, label, weight, fold and copies; ``pack`` makes bytes of the x of a block."""
    from pyspark import TaskContext

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        held, count = [], 0

        def told() -> pd.DataFrame:
            whole = pd.concat(held, ignore_index=True)
            return pd.DataFrame(
                {
                    "block": [number], "rows": [np.int32(len(whole))],
                    "x": [pack(whole["x"].to_numpy())],
                    "label": [whole["label"].to_numpy().tobytes()],
                    "weight": [whole["weight"].to_numpy().tobytes()],
                    "fold": [whole["fold"].to_numpy(np.int32).tobytes()],
                    "copies": [whole["copies"].to_numpy().tobytes()],
                }
            )

        for frame in frames:
            for at in range(0, len(frame), block_rows):
                part = frame.iloc[at : at + block_rows]
                if count and count + len(part) > block_rows:
                    yield told()
                    number, held, count = number + 1, [], 0
                held.append(part)
                count += len(part)
        if count:
            yield told()

    return rows.mapInPandas(gather, _BLOCK).persist(StorageLevel.MEMORY_AND_DISK)


def pass_over(
    blocks: DataFrame, work: Callable[[Block], dict[int, np.ndarray]], read: Callable = read_block,
    join: Callable = np.add,
) -> dict[int, np.ndarray]:
    """Sums (or what else ``join`` makes of two) over all blocks of the arrays ``work`` gives by key.

    A partition adds up its own blocks; arrays of a key meet in one task, and its sum is fetched.
    Their number and size depend on the runs and features, not on the rows.
    """

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for row in frame.itertuples(index=False):
                for key, values in work(read(row)).items():
                    if key in sums:
                        sums[key] = join(sums[key], values)
                    else:
                        sums[key] = values
        yield pd.DataFrame(
            {"key": list(sums), "sums": [np.asarray(v, float).ravel().tobytes() for v in sums.values()]}
        ).astype({"key": "int64"})

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        whole = join.reduce([np.frombuffer(s) for s in frame["sums"]])
        return pd.DataFrame({"key": [frame["key"].iloc[0]], "sums": [whole.tobytes()]})

    schema = "key long, sums binary"
    rows = blocks.mapInPandas(partial, schema).groupBy("key").applyInPandas(total, schema).collect()
    return {r["key"]: np.frombuffer(r["sums"]) for r in rows}


def held_blocks(blocks: DataFrame) -> RDD:
    """Blocks as objects of Python, kept for many passes that are short: a pass needs no plan."""
    parts = blocks.sparkSession.sparkContext.defaultParallelism
    return blocks.repartition(parts, "block").rdd.map(read_block).persist(StorageLevel.MEMORY_AND_DISK)


def pass_held(held: RDD, work: Callable, size: int, most_bytes: int = TOLD_BYTES) -> dict[int, np.ndarray]:
    """Sums over all blocks of the arrays ``work`` gives by key, as ``pass_over`` tells them.

    Partitions add up their own blocks. Where these sums, of ``size`` bytes each, are many, those of a
    key meet in a task first.
    """

    def partial(blocks: Iterator[Block]) -> Iterator[dict[int, np.ndarray]]:
        sums: dict[int, np.ndarray] = {}
        for block in blocks:
            for key, values in work(block).items():
                sums[key] = sums[key] + values if key in sums else values
        yield sums

    parts = held.mapPartitions(partial)
    if size * held.getNumPartitions() > most_bytes:
        return dict(parts.flatMap(dict.items).reduceByKey(np.add).collect())
    out: dict[int, np.ndarray] = {}
    for sums in parts.collect():
        for key, values in sums.items():
            out[key] = out[key] + values if key in out else values
    return out


def apart(frame: DataFrame, key: str, count: int) -> DataFrame:
    """Groups of a key in partitions of their own as far as may be, as each is long work on few bytes.

    A given number of partitions is not merged where they are small.
    """
    return frame.repartition(min(2 * count, 1000), key)


def folds_of(folds: int | Sequence[int]) -> list[int]:
    """Folds of a search, and the run over all rows that gives the final model."""
    return [*(range(folds) if isinstance(folds, int) else folds), WHOLE]
