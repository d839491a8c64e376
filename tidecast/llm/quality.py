"""Quality rules with a linear-chain conditional random field over lines.

Each line of a text is labelled content or boilerplate by Viterbi decoding; the share of
words in content lines decides whether the text is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm import crf
from tidecast.llm.common import map_rows

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
N_FEATURES = 15
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """Weights of the line features for the labels boilerplate (0) and content (1), and the moves between them."""

    weights: np.ndarray
    moves: np.ndarray


def line_features(line: bytes, words: list[bytes], again: bool) -> tuple[float, ...]:
    """Numbers between 0 and 1 that describe a line with words."""
    size = sum(map(len, words))
    n = len(words)
    symbols = size - len(b"".join(words).translate(None, SYMBOLS))
    text = line.decode("utf-8", "replace").strip()
    upper = sum(map(str.isupper, text)) / max(1, sum(map(str.isalpha, text)))
    return (
        1.0,
        float(n < 4),
        float(n < 12),
        float(n >= 30),
        min(1.0, 4 * symbols / size),
        float(symbols > 0),
        upper,
        float(upper > 0.5),
        min(1.0, 4 * sum(map(str.isdigit, text)) / len(text or " ")),
        float(text[-1:] in ".!?…\"'»”"),
        float(again),
        1 - len(set(words)) / n,
        min(1.0, 4 * line.count(b"!") / n),
        float(b"://" in line or b"www." in line or b"@" in line),
        min(1.0, size / n / 20),
    )


def lines_of(text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    r"""Of the ``\n``-split lines with a word: their features, their numbers of words, and how many equal an earlier one."""
    seen: set[bytes] = set()
    rows, sizes, repeated = [], [], 0
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            again = line in seen
            seen.add(line)
            repeated += again
            rows.append(line_features(line, words, again))
            sizes.append(len(words))
    return np.array(rows, "float64").reshape(-1, N_FEATURES), np.array(sizes, "int64"), repeated


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words which the text holds twice or more."""
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), "uint64", len(words))
    if len(numbers) == len(words):
        return 0
    mixed = (ids + np.uint64(1)) * _MULTIPLIER
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    n = len(words) - window + 1
    hashes = np.zeros(n, "uint64")
    for k in range(window):
        hashes = hashes * np.uint64(0xD1342543DE82EF95) + mixed[k : k + n]
    _, place, count = np.unique(hashes, return_inverse=True, return_counts=True)
    twice = np.zeros(len(words) + 1, "int64")
    at = np.flatnonzero(count[place] > 1)
    np.add.at(twice, at, 1)
    np.add.at(twice, at + window, -1)
    return int((np.cumsum(twice) > 0).sum())


def spliced(good: list[np.ndarray], bad: list[np.ndarray], seed: int = 42) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sequences of lines that take turns between a good and a bad text, in runs of one to four lines, and their labels.

    Every text is in one at least; the shorter list is gone through again.
    """
    if not good or not bad:
        return []
    rng, found = np.random.default_rng(seed), []
    for k in range(max(len(good), len(bad))):
        own = [bad[k % len(bad)], good[k % len(good)]]
        at, turn, parts, labels = [0, 0], int(rng.integers(2)), [], []
        while at[0] < len(own[0]) or at[1] < len(own[1]):
            part = own[turn][at[turn] : at[turn] + int(rng.integers(1, 5))]
            at[turn] += len(part)
            parts.append(part)
            labels.append(np.full(len(part), turn))
            turn = 1 - turn
        found.append((np.concatenate(parts), np.concatenate(labels)))
    return found


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = 2000,
    longest: int = 20_000,
) -> Model | None:
    """A model from at most ``sample`` labelled texts; None if there are none.

    The sample is the ``sample`` labelled keys of smallest hash, without texts over
    ``longest`` characters; only this list of keys is broadcast.

    The lines of a good text (label 1) are content, those of a bad one boilerplate. As such
    texts never change their label within, every good and bad one are also spliced to texts that
    do (``spliced``), or the chain would learn that labels never change. A key
    with two labels counts as good if any is; rows without a label are not learned from.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
    marks = marks.agg(F.max(label).cast("int").alias("_label"))
    chosen = marks.orderBy(F.xxhash64(F.col("_key").cast("string")), "_key").limit(sample)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key")
    rows = rows.where(F.char_length("_text").between(1, longest)).limit(sample)
    found = sorted((r["_key"], r["_text"], r["_label"]) for r in rows.collect())
    lines = [(lines_of(whole.encode("utf-8", "replace"))[0], int(own > 0)) for _, whole, own in found]
    lines = [x for x in lines if len(x[0])]
    if not lines:
        return None
    lines = [(x, np.full(len(x), y)) for x, y in lines]
    lines += spliced([x for x, y in lines if y[0]], [x for x, y in lines if not y[0]])
    items = np.concatenate([x for x, _ in lines])
    lengths = np.array([len(x) for x, _ in lines])
    marked = np.concatenate([y for _, y in lines]).astype("int64")
    weights, moves = crf.fit(lambda w: items @ w, lambda g: items.T @ g, (N_FEATURES, 2), marked, lengths, rounds=150)
    return Model(weights, moves)


def judge(
    docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", share: float = 0.5
) -> DataFrame:
    """Per row: key, the counts of the base rules, base_failed, content_share and kept.

    Kept are texts that pass the base rules (at least 20 words, at most 30 % of them in
    repeated windows) and whose content lines hold at least ``share`` of the words. A null
    text has no words and fails. Without a model every line is content. Repeated rows are
    returned each; other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, content_share double, kept boolean"
    )

    def rows(batch):
        counted, features, lengths, sizes = [], [], [], []
        for doc, whole in zip(batch["_key"], batch["_text"]):
            text = (whole or "").encode("utf-8", "replace")
            words = text.split()
            spaces = len(text) - sum(map(len, words))
            own, size, again = lines_of(text)
            symbols = len(text) - len(text.translate(None, SYMBOLS))
            counted.append((doc, len(words), len(whole or "") - spaces, symbols, again, repeated_words(words)))
            features.append(own)
            lengths.append(len(own))
            sizes.append(size)
        items, size = np.concatenate(features), np.concatenate(sizes)
        content = crf.viterbi(items @ model.weights, np.array(lengths), model.moves) if model else np.ones(len(items), "int8")
        ends = np.cumsum(lengths)
        inside = np.concatenate([[0], np.cumsum(size * content)])
        for row, end, n in zip(counted, ends.tolist(), lengths):
            failed = row[1] < 20 or 100 * row[5] > 30 * row[1]
            own = float(inside[end] - inside[end - n]) / row[1] if row[1] else 0.0
            yield (*row, failed, own, not failed and own >= share)

    return map_rows(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), schema, rows)
