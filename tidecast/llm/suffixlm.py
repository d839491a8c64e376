"""A probabilistic suffix tree over words as language model.

The tree holds contexts of up to two words. A context is a candidate if it occurs with a next
symbol at least ``LEAST`` times, and is retained if its next-symbol distribution diverges
from its parent's (the context without its first word) by at least ``DIVERGENCE`` nats. A
state lists the next symbols that occur with it at least ``LEAST`` times; their counts are
discounted, and what that frees is spread like the parent's distribution, down to the root,
whose distribution is the add-one unigram. A token is scored in the longest retained suffix of
the words before it. A text begins in the state of the end symbol.

So the log-probability of a text is a sum over its words and word sequences: the unigram's
logarithm, what a listed symbol gains over its parent's probability, and the share that a
retained context leaves. Only sequences that occur ``LEAST`` times have an addend, and these
addends are tables, however large. The most frequent words and sequences (shares ``WORD`` and
``NEXT`` of the tokens) also travel with the tasks; all others are joined by hash, never
broadcast. The shares decide where an addend is looked up, not whether it counts. Words and
sequences are known by 64-bit hashes.
"""

from __future__ import annotations

import dataclasses
import functools
import itertools
import math
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import arrow_types, ascii_lower, columns_of, dropped, staged

WORD = 1e-6
NEXT = 2e-7
LEAST = 3
DIVERGENCE = 0.02
DISCOUNT = 0.5
LEVELS = 2
_BLOCK = 1_000_000
_PARTS = 16
_SEGMENT = 16
_MOST_BITS = 27


def hash_of(word: bytes) -> int:
    """Signed 64-bit hash of a word; that of no bytes is the end symbol."""
    import xxhash

    value = xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = found = hash_of(word)
        return found


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in sorted ``keys``; -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1, "int64")
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _mixed(seed, value: np.ndarray) -> np.ndarray:
    """XXH64 of 64-bit integers, each with a seed of its own."""
    turn = lambda x, by: (x << np.uint64(by)) | (x >> np.uint64(64 - by))
    p1, p2, p3 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    found = (seed + np.uint64(0x27D4EB2F165667C5 + 8)) ^ (turn(value.view("uint64") * p2, 31) * p1)
    found = turn(found, 27) * p1 + np.uint64(0x85EBCA77C2B2AE63)
    found = (found ^ (found >> np.uint64(33))) * p2
    found = (found ^ (found >> np.uint64(29))) * p3
    return found ^ (found >> np.uint64(32))


def gram_of(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The hash of a context with a next symbol, as Spark's ``xxhash64`` of the two."""
    return _mixed(_mixed(np.full(1, 42, "uint64"), context), symbol).view("int64")


@dataclass
class Tree:
    """The words (sorted hashes, counts, logarithms of what their states leave) and sequences that travel with tasks.

    ``gains`` are the logarithms by which sequences as listed symbols exceed what their contexts
    leave for the parents, ``turns`` those of what sequences leave as contexts. ``grams`` has all sequences
    (key, n, gain, turn), of which those of at least ``enough`` occurrences are in the arrays, and
    ``bits`` is a filter of all.
    """

    total: int
    distinct: int
    words: np.ndarray
    counts: np.ndarray
    states: np.ndarray
    keys: np.ndarray
    gains: np.ndarray
    turns: np.ndarray
    bits: np.ndarray
    least: int
    enough: int
    grams: DataFrame | None = None

    @property
    def mass(self) -> int:
        return self.total + self.distinct + 1

    def unigram(self, word: np.ndarray) -> np.ndarray:
        return (self.counts[word] + 1) / self.mass

    def probabilities(self, before2: np.ndarray, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """P(word | state) of places in ``words`` (-1: none), by the arrays; for words outside them the unigram's factor."""
        root = np.where(word >= 0, self.unigram(word), 1.0)
        last, two, one = self.words[word], self.words[before2], self.words[before]
        pair = _find(self.keys, gram_of(two, one))
        pair = np.where((before2 >= 0) & (before >= 0), pair, -1)
        next1 = np.where((before >= 0) & (word >= 0), _find(self.keys, gram_of(one, last)), -1)
        next2 = np.where((pair >= 0) & (word >= 0), _find(self.keys, gram_of(gram_of(two, one), gram_of(one, last))), -1)
        logs = np.where(before >= 0, self.states[before], 0.0)
        if len(self.keys):
            logs = logs + np.where(pair >= 0, self.turns[pair], 0.0)
            logs = logs + np.where(next1 >= 0, self.gains[next1], 0.0) + np.where(next2 >= 0, self.gains[next2], 0.0)
        return root * 10.0**logs


def _maybe(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a filter may hold the keys; false only if it does not."""
    at = keys & (8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7).astype("u1")) & 1 == 1


def _filter(keys: DataFrame) -> np.ndarray:
    """A filter of the column ``key``: 16 bits a key, at most 2 ** ``_MOST_BITS``; a full one only saves no work."""
    import pyarrow as pa

    wanted = max(1, 16 * keys.count()).bit_length()
    size = 1 << min(max(wanted, _SEGMENT), _MOST_BITS)
    at = F.col("key").bitwiseAND(F.lit(size - 1))
    places = keys.select(F.shiftright(at, _SEGMENT).cast("int").alias("segment"), at.bitwiseAND(F.lit((1 << _SEGMENT) - 1)).cast("int").alias("at"))

    def run(key, table):
        held = np.zeros(1 << _SEGMENT, bool)
        held[table.column("at").to_numpy()] = True
        return pa.table({"segment": pa.array([key[0].as_py()], "int32"), "bits": pa.array([np.packbits(held, bitorder="little").tobytes()], "binary")})

    bits = np.zeros(size >> 3, "u1")
    segments = staged(places.distinct().groupBy("segment").applyInArrow(run, "segment int, bits binary"), "filter")
    for row in segments.collect():
        at = row["segment"] << _SEGMENT - 3
        bits[at : at + (1 << _SEGMENT - 3)] = np.frombuffer(row["bits"], "u1")
    return bits


def _texts(batches, size: int = _BLOCK):
    """Blocks of about ``size`` tokens: the other columns' rows, all token hashes, tokens of each text."""
    cache, end = _Hashes(), hash_of(b"")
    rows, hashes, held = [], [], 0
    for columns in columns_of(batches):
        others = [columns[c] for c in columns if c != "_text"]
        for at, whole in enumerate(columns["_text"]):
            words = ascii_lower(whole or "").split()
            rows.append(tuple(c[at] for c in others))
            hashes.append(np.fromiter(map(cache.__getitem__, words), "int64", len(words)))
            hashes.append(np.array([end]))
            held += len(words) + 1
            if held >= size:
                yield rows, np.concatenate(hashes), np.array([len(h) + 1 for h in hashes[::2]])
                rows, hashes, held = [], [], 0
    if rows:
        yield rows, np.concatenate(hashes), np.array([len(h) + 1 for h in hashes[::2]])


def _levels(hashes: np.ndarray, lengths: np.ndarray):
    """Per level the contexts, the symbols as the level below knows them, and whether a token has such a context.

    Level 0 has words in words, level 1 pairs in pairs. A text follows an end symbol, and before that is nothing.
    """
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(hashes)) - np.repeat(starts, lengths)
    now, before = hashes, np.concatenate([hashes[:1], hashes[:-1]])
    before[starts] = hash_of(b"")
    for level in range(LEVELS):
        yield before, now, place >= level
        if level + 1 < LEVELS:
            now = gram_of(before, now)
            before = np.concatenate([now[:1], now[:-1]])


def _counted(texts: DataFrame, level: int, bits: np.ndarray | None = None) -> DataFrame:
    """How often (a, b), a context and a symbol of a level, occur in all texts, counted in blocks first.

    Level 0 has the words too, as (word, 0) with ``part`` -1. Of higher levels only those whose
    context and symbol ``bits`` may hold are counted.
    """
    schema = "a long, part int, b long, n long"
    types = arrow_types(schema)

    def run(batches):
        import pyarrow as pa

        for _, hashes, lengths in _texts(batches, 2 * _BLOCK):
            before, now, valid = next(itertools.islice(_levels(hashes, lengths), level, None))
            if level:
                valid = valid & _maybe(bits, now)
                valid[valid] = _maybe(bits, before[valid])
                before, now = before[valid], now[valid]
            contexts, of_context = np.unique(before, return_inverse=True)
            symbols, of_symbol = np.unique(now, return_inverse=True)
            joint, n = np.unique(of_context * len(symbols) + of_symbol, return_counts=True)
            a, b = contexts[joint // max(1, len(symbols))], symbols[joint % max(1, len(symbols))]
            found = [(a, (b & (_PARTS - 1)).astype("int32"), b, n)]
            if not level:
                size = len(symbols)
                found.append((symbols, np.full(size, -1, "int32"), np.zeros(size, "int64"), np.bincount(of_symbol, minlength=size)))
            for columns in found:
                for at in range(0, len(columns[0]), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)]) for c in columns], schema=types)

    # Symbols of one context stay together, so that they compress, and hot contexts are in several parts.
    return texts.mapInArrow(run, schema).repartition("a", "part").groupBy("a", "part", "b").agg(F.sum("n").alias("n"))


def _level(grams: DataFrame, lower: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sequences (key, n, gain, p) and the retained contexts (key, turn) of a level, staged.

    ``grams`` has (a, b, n), ``lower`` how often contexts and symbols (key) occur, n, and their probabilities p one level down.
    """
    joined = grams.join(lower.select(F.col("key").alias("a"), F.col("n").alias("_all")), "a")
    joined = staged(joined.join(lower.select(F.col("key").alias("b"), F.col("p").alias("_low")), "b"), "joined")
    share, value = F.col("n") / F.col("_all"), (F.col("n") - DISCOUNT) / F.col("_all")
    sums = joined.groupBy("a").agg(
        F.sum(share).alias("_share"), F.sum("_low").alias("_lows"), F.sum(share * F.log(share / F.col("_low"))).alias("_apart"), F.sum(value).alias("_value")
    )
    left, low_left = F.greatest(1 - F.col("_share"), F.lit(1e-12)), F.greatest(1 - F.col("_lows"), F.lit(1e-12))
    kept = sums.where(F.col("_apart") + left * F.log(left / low_left) >= DIVERGENCE)
    kept = staged(kept.select("a", (1 - F.col("_value")).alias("_beta")), "states")
    p = F.when(F.col("_beta").isNull(), F.col("_low")).otherwise(value + F.col("_beta") * F.col("_low"))
    gain = F.when(F.col("_beta").isNull(), F.lit(0.0)).otherwise(F.log10(p / (F.col("_beta") * F.col("_low"))))
    done = joined.join(kept, "a", "left").select(F.xxhash64("a", "b").alias("key"), "n", gain.alias("gain"), p.alias("p"))
    done = staged(done, "level")
    dropped(joined)
    return done, kept.select(F.col("a").alias("key"), F.log10("_beta").alias("turn"))


def _arrays(df: DataFrame) -> list[np.ndarray]:
    """The columns of a bounded table, sorted by the first."""
    found = df.toArrow()
    columns = [c.to_numpy() for c in found.columns]
    order = np.argsort(columns[0])
    return [c[order] for c in columns]


def train(docs: DataFrame, learn: Column, text: str = "text") -> tuple[Tree, DataFrame]:
    """The tree, and the staged counts (key, n) of all training words with ``turn``, from whole texts of the rows where ``learn`` holds."""
    texts = docs.where(learn).select(F.col(text).alias("_text"))
    counts = staged(_counted(texts, 0).where((F.col("part") < 0) | (F.col("n") >= LEAST)), "counts")
    words = counts.where("part < 0").select(F.col("a").alias("key"), "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    mass = F.lit(float(total + distinct + 1))

    grams = counts.where("part >= 0").select("a", "b", "n")
    contexts = words.where(F.col("n") >= LEAST).select("key", "n", ((F.col("n") + 1) / mass).alias("p"))
    levels, turns = [], []
    for level in range(LEVELS):
        if level:
            grams = _counted(texts, level, _filter(levels[-1].select("key"))).where(F.col("n") >= LEAST).select("a", "b", "n")
            contexts = levels[-1]
        found, kept = _level(grams, contexts)
        levels.append(found)
        turns.append(kept)

    none = F.lit(0.0)
    words = staged(words.join(turns[0], "key", "left").select("key", "n", F.coalesce("turn", none).alias("turn")), "words")
    parts = [f.join(t, "key", "left").select("key", "n", "gain", F.coalesce("turn", none).alias("turn")) for f, t in zip(levels, turns[1:])]
    every = functools.reduce(DataFrame.unionByName, [*parts, levels[-1].select("key", "n", "gain", none.alias("turn"))])
    every = staged(every.where("gain <> 0 or turn <> 0"), "sequences")
    dropped(counts, *levels, *turns)

    end = hash_of(b"")
    least, enough = max(2, math.ceil(WORD * total)), max(LEAST, math.ceil(NEXT * total))
    own, n, states = _arrays(words.where((F.col("n") >= least) | (F.col("key") == end)))
    if not (own == end).any():
        at = np.searchsorted(own, end)
        own, n, states = np.insert(own, at, end), np.insert(n, at, 0), np.insert(states, at, 0.0)
    keys, _, gains, left = _arrays(every.where(F.col("n") >= enough))
    return Tree(total, distinct, own, n, states, keys, gains, left, _filter(every.select("key")), least, enough, every), words


def score(docs: DataFrame, tree: Tree, counts: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score and score, over the whole text.

    A null text is empty and has its end symbol alone. ``base_score`` is the add-one
    unigram's log10 probability, ``score`` the tree's. Without training texts both are that
    of a lone unknown symbol, 0. Repeated rows are returned each; other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    own_schema = f"doc {kind}, held boolean, tokens long, known long, base double, gain double"
    schema = f"row long, key long, own struct<{', '.join(c.replace(' ', ': ', 1) for c in own_schema.split(', '))}>"
    types, own_types = arrow_types(schema), list(arrow_types(own_schema))
    hot = dataclasses.replace(tree, grams=None)

    def run(batches):
        import pyarrow as pa

        logs, unknown = np.log10((hot.counts + 1) / hot.mass), math.log10(1 / hot.mass)
        row = TaskContext.get().partitionId() << 33
        for rows, hashes, lengths in _texts(batches):
            ids = _find(hot.words, hashes)
            listed = ids >= 0
            base, gain = np.where(listed, logs[ids], unknown), np.where(listed, hot.states[ids], 0.0)
            places, rare = [np.flatnonzero(~listed)], [hashes[~listed]]
            for before, now, valid in _levels(hashes, lengths):
                sequence = gram_of(before, now)
                at = np.flatnonzero(valid & _maybe(hot.bits, sequence))
                sequence = sequence[at]
                own = _find(hot.keys, sequence)
                found = own >= 0
                gain[at[found]] += hot.gains[own[found]] + hot.turns[own[found]]
                if hot.enough > LEAST:
                    places.append(at[~found])
                    rare.append(sequence[~found])
            starts = np.cumsum(lengths) - lengths
            known = listed & (hot.counts[ids] > 0)
            sums = [np.add.reduceat(x, starts) for x in (known.astype("int64"), base, gain)]
            numbers = pa.array(np.arange(row, row + len(rows)))
            columns = [pa.array(c, t.type) for c, t in zip([*zip(*rows), lengths, *sums], own_types)]
            own = pa.StructArray.from_arrays(columns, fields=own_types)
            # A text's own row has its number as the key, so that these rows are spread as well.
            yield from pa.Table.from_arrays([numbers, numbers, own], schema=types).to_batches(4096)
            rare = np.concatenate(rare)
            of_row = row + np.searchsorted(starts, np.concatenate(places), "right") - 1
            for at in range(0, len(rare), 1 << 16):
                part = [pa.array(c[at : at + (1 << 16)]) for c in (of_row, rare)]
                yield pa.RecordBatch.from_arrays([*part, pa.nulls(len(part[0]), types.field("own").type)], schema=types)
            row += len(rows)

    texts = docs.select(F.col(key).alias("_key"), held_out.alias("_held"), F.col(text).alias("_text"))
    words = counts.where(F.col("n") < tree.least).select("key", F.log10(F.col("n") + 1).alias("_base"), F.lit(1).alias("_known"), F.col("turn").alias("_gain"))
    more = tree.grams.where(F.col("n") < tree.enough).select("key", F.lit(0.0).alias("_base"), F.lit(0).alias("_known"), (F.col("gain") + F.col("turn")).alias("_gain"))
    # A hash join, since the texts' side is many times the size of the addends and need not be sorted.
    looked_up = texts.mapInArrow(run, schema).join(words.unionByName(more).hint("shuffle_hash"), "key", "left").select("row", "own.*", "_base", "_known", "_gain")
    added = [F.sum(F.coalesce(c, f"_{c}")).alias(c) for c in ("base", "known", "gain")]
    done = looked_up.groupBy("row").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("doc", "held", "tokens")], *added)
    return done.select(
        F.col("doc").alias(key),
        F.col("held").alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        F.col("known").cast("long").alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("base") + F.col("gain")).alias("score"),
    )
