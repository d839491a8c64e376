"""A small text network: averaged word embeddings, a hidden layer and a softmax, trained on Spark.

Words are hashed to ``buckets`` rows of an embedding table; a text is the mean of its words' rows,
``tanh(mean A + a)`` its hidden layer and ``softmax(hidden B + b)`` the chances of its classes. A
step sums the gradients of all rows: every task adds up its own, and block after block of
the weights is summed over the tasks by a shuffle. What reaches the driver has the size of the
network, whatever the number of texts. A batch's gradient is rounded to multiples of 2^-32 before it
is added, so neither the order in which tasks end nor a repeated task changes the result.

Weights and optimiser state are written every few steps; a fit that is given the same folder again
goes on from the last complete step and ends with the same network.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions import text
from tidecast.operators.boosting import _arrow_schema
from tidecast.session import scratch_dir

_UNIT = 1 << 32
_BLOCK = 4096
#: Decay of the mean and the square of the gradient, and what keeps the quotient finite.
_FIRST, _SECOND, _LEAST = 0.9, 0.999, 1e-8
#: Cells of a table of word counts that is held at once.
_CELLS = 1 << 20


@dataclass(frozen=True)
class Shape:
    """Sizes of the network and settings of its training."""

    classes: int
    buckets: int = 1 << 12
    width: int = 16
    hidden: int = 16
    steps: int = 40
    rate: float = 0.05
    penalty: float = 1e-4
    seed: int = 42
    keep_every: int = 10

    def sizes(self) -> list[tuple[int, int]]:
        return [(self.buckets, self.width), (self.width, self.hidden), (1, self.hidden), (self.hidden, self.classes), (1, self.classes)]

    def parts(self, flat: np.ndarray) -> list[np.ndarray]:
        """Embeddings, A, a, B and b as views of one flat array."""
        ends = np.cumsum([r * c for r, c in self.sizes()])
        return [flat[e - r * c : e].reshape(r, c) for e, (r, c) in zip(ends, self.sizes())]

    def start(self) -> np.ndarray:
        """The first weights, from the seed alone."""
        rng = np.random.default_rng(self.seed)
        whole = [rng.normal(0, (1 / max(r, 1)) ** 0.5 if k else 1.0, (r, c)) for k, (r, c) in enumerate(self.sizes())]
        whole[2][:], whole[4][:] = 0, 0
        return np.concatenate([w.ravel() for w in whole])


@dataclass(frozen=True)
class Network:
    """A trained network."""

    shape: Shape
    weights: np.ndarray

    def hidden(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mean embedding and the hidden layer of texts whose words end at ``ends``; no word gives zeros."""
        table, first, shift, *_ = self.shape.parts(self.weights)
        mean = np.zeros((len(ends), self.shape.width))
        for rows, seen, shares in _shares(ids, ends, self.shape.buckets):
            mean[rows] = shares @ table[seen]
        return mean, np.tanh(mean @ first + shift)

    def chances(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The probability of every class of every text."""
        return self._chances(self.hidden(ids, ends)[1])

    def _chances(self, hidden: np.ndarray) -> np.ndarray:
        *_, last, shift = self.shape.parts(self.weights)
        scores = hidden @ last + shift
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)

    def slopes(self, ids: np.ndarray, ends: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The gradient of the summed log loss, flat."""
        _, first, _, last, _ = self.shape.parts(self.weights)
        found = np.zeros(len(self.weights))
        table, d_first, d_shift, d_last, d_out = self.shape.parts(found)
        mean, hidden = self.hidden(ids, ends)
        wrong = self._chances(hidden)
        wrong[np.arange(len(labels)), labels] -= 1
        d_last += hidden.T @ wrong
        d_out += wrong.sum(axis=0)
        back = (wrong @ last.T) * (1 - hidden**2)
        d_first += mean.T @ back
        d_shift += back.sum(axis=0)
        below = back @ first.T
        for rows, seen, shares in _shares(ids, ends, self.shape.buckets):
            table[seen] += shares.T @ below[rows]
        return found


def _shares(ids: np.ndarray, ends: np.ndarray, buckets: int) -> Iterator[tuple[slice, np.ndarray | slice, np.ndarray]]:
    """Blocks of rows, the buckets of their words, and each bucket's share of a row's words; ``_CELLS`` bounds a block of several rows."""
    ends = np.asarray(ends)
    at = 0
    while at < len(ends):
        start = ends[at - 1] if at else 0
        # Distinct words are at most the buckets, and at most the words so far.
        cells = np.minimum(ends[at : at + _CELLS // 64] - start, buckets) * np.arange(1, len(ends[at : at + _CELLS // 64]) + 1)
        to = at + max(1, int(np.searchsorted(cells, _CELLS, "right")))
        own, counts = ids[start : ends[to - 1]], np.diff(ends[at:to], prepend=start)
        seen, width = slice(None), buckets
        if len(own) < buckets:
            seen, own = np.unique(own, return_inverse=True)
            width = len(seen)
        cell = np.repeat(np.arange(to - at) * width, counts) + own
        found = np.bincount(cell, minlength=(to - at) * width).reshape(to - at, width)
        yield slice(at, to), seen, found / np.maximum(counts, 1)[:, None]
        at = to


def _words(df: DataFrame, shape: Shape, text_col: str, pair_col: str | None) -> DataFrame:
    """``df`` with ``ids``, the buckets of its words; with a pair text, each word counts for that pair alone.

    ``text_col`` is a text or an array of its lower-case words.
    """
    words = text.words(df, text_col)
    pair = F.lit("") if pair_col is None else F.coalesce(F.col(pair_col), F.lit(""))
    return df.withColumn("ids", F.transform(words, lambda w: F.pmod(F.xxhash64(pair, w), F.lit(shape.buckets)).cast("int")))


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """The values of an Arrow list column, and where each row's end."""
    lengths = column.value_lengths().fill_null(0).to_numpy()
    return column.flatten().to_numpy(), np.cumsum(lengths)


def _gradient(rows: DataFrame, network: Network) -> tuple[np.ndarray, int]:
    """The summed gradient of all rows and their number."""
    import pyarrow as pa

    size = len(network.weights)

    def own(batches):
        total, n = np.zeros(size, "int64"), 0
        for batch in batches:
            if batch.num_rows:
                ids, ends = _lists(batch.column("ids"))
                labels = batch.column("y").to_numpy()
                total += np.rint(network.slopes(ids, ends, labels) * _UNIT).astype("int64")
                n += batch.num_rows
        if n:
            for at in range(0, size, _BLOCK):
                part = total[at : at + _BLOCK]
                if part.any() or not at:
                    yield pa.RecordBatch.from_pydict({"block": pa.array([at // _BLOCK], pa.int32()), "sums": [part.tobytes()], "n": [n if not at else 0]})

    def joined(batches):
        sums: dict[int, np.ndarray] = {}
        n = 0
        for batch in batches:
            for block, part, rows_in in zip(*(batch.column(c).to_pylist() for c in ("block", "sums", "n"))):
                sums[block] = sums.get(block, 0) + np.frombuffer(part, "int64")
                n += rows_in
        for block, part in sums.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "sums": [part.tobytes()], "n": [n]})
            n = 0

    schema = "block int, sums binary, n long"
    found = rows.mapInArrow(own, schema).repartition("block").mapInArrow(joined, schema).collect()
    total = np.zeros(size)
    for r in found:
        part = np.frombuffer(r["sums"], "int64") / _UNIT
        total[r["block"] * _BLOCK : r["block"] * _BLOCK + len(part)] = part
    return total, sum(r["n"] for r in found)


def _save(spark: SparkSession, path: str, step: int, state: list[np.ndarray]) -> None:
    rows = [(k, bytearray(part.tobytes())) for k, part in enumerate(state)]
    spark.createDataFrame(rows, "part int, raw binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/step={step:06d}")


def _load(spark: SparkSession, path: str) -> tuple[int, list[np.ndarray]] | None:
    """The last step whose write was completed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    done = [n for n in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    if not done:
        return None
    rows = spark.read.parquet(f"{path}/{max(done)}").orderBy("part").collect()
    return int(max(done).partition("=")[2]), [np.frombuffer(r["raw"], "float64").copy() for r in rows]


def fit(
    labelled: DataFrame,
    shape: Shape,
    label: str = "label",
    text_col: str = "content",
    pair_col: str | None = None,
    path: str | None = None,
    until: int | None = None,
) -> Network:
    """Train on the rows with a label from 0 to ``shape.classes - 1``; others are left out.

    ``path`` keeps the state every ``keep_every`` steps and is taken up again; ``until`` stops early.
    Without a labelled row the first weights stay as they are.
    """
    spark = labelled.sparkSession
    y = F.col(label).cast("int")
    rows = _words(labelled.where(y.between(0, shape.classes - 1)), shape, text_col, pair_col).select("ids", y.alias("y"))
    stored = scratch_dir(spark, "network-rows")
    rows.write.parquet(stored)
    rows = spark.read.schema("ids array<int>, y int").parquet(stored)
    weights = shape.start()
    state, first = [weights, np.zeros_like(weights), np.zeros_like(weights)], 0
    if path and (kept := _load(spark, path)):
        first, state = kept
    for step in range(first, min(shape.steps, until or shape.steps)):
        weights, mean, square = state
        slope, n = _gradient(rows, Network(shape, weights))
        if not n:
            break
        slope = slope / n + shape.penalty * weights
        mean = _FIRST * mean + (1 - _FIRST) * slope
        square = _SECOND * square + (1 - _SECOND) * slope**2
        moved = mean / (1 - _FIRST ** (step + 1)) / (np.sqrt(square / (1 - _SECOND ** (step + 1))) + _LEAST)
        state = [weights - shape.rate * moved, mean, square]
        if path and ((step + 1) % shape.keep_every == 0 or step + 1 == shape.steps):
            _save(spark, path, step + 1, state)
    return Network(replace(shape), state[0])


def load_scorer(network: Network, batch_size: int = 32) -> Callable:
    """A function over Arrow batches that yields (rows, chances) for ``batch_size`` texts at a time."""

    def score(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, batch_size):
                part = batch.slice(at, batch_size)
                yield part, network.chances(*_lists(part.column("ids")))

    return score


def classify(
    network: Network,
    df: DataFrame,
    text_col: str = "content",
    pair_col: str | None = None,
    batch_size: int = 32,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with ``prediction`` (class index, the first of equals) and ``probabilities``. A text without words has the bias alone.

    ``keep`` names the columns to return, by default all; a text that is not kept does not travel to the workers.
    """
    names = df.columns if keep is None else list(keep)
    target = df.select(*names, F.lit(0).alias("prediction"), F.array(F.lit(0.0)).alias("probabilities"))
    arrow, score = _arrow_schema(target), load_scorer(network, batch_size)

    def run(batches):
        import pyarrow as pa

        for part, chances in score(batches):
            columns = [*[part.column(c) for c in names], pa.array(chances.argmax(axis=1).astype("int32")), pa.array(chances.tolist())]
            yield pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, arrow)], schema=arrow)

    return _words(df, network.shape, text_col, pair_col).select(*names, "ids").mapInArrow(run, target.schema)
