"""Language identification of code-switched text by a linear-chain conditional random field over words.

A word's features are its affixes, character n-grams and an entry in a lexicon of each
language; the labels' moves are learned with them. Forward-backward labels every word of the
whole text, so a text may change its language on the way.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm import crf
from tidecast.llm.common import arrow_types, columns_of, forget_words, record_batches, release

FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
NONE = "und"


@dataclass
class Model:
    """``langs`` in order of their labels, feature weights, moves, and the lexicon (word: label)."""

    langs: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicon: dict[str, int]


def letters(token: str) -> str:
    """A token's letters in lower case."""
    return token.lower() if token.isalpha() else "".join(filter(str.isalpha, token)).lower()


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words of letters: pairs of a word's number and a feature.

    They are a word's character n-grams of one to three, with its ends marked, its affixes of
    up to four letters, and the language of its lexicon entry. All words are hashed at once.
    """
    text = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "replace"), "<u4").astype("uint64")
    sizes = np.fromiter(map(len, words), "int64", len(words)) + 2
    ends = np.cumsum(sizes)
    starts, owner = ends - sizes, np.repeat(np.arange(len(words)), sizes)
    room = np.repeat(ends, sizes) - np.arange(len(text))
    whose, found = [], []

    def add(kind: int, at: np.ndarray, hashes: np.ndarray) -> None:
        salted = (hashes + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        salted = (salted ^ (salted >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        whose.append(owner[at])
        found.append((salted >> np.uint64(64 - FEATURE_BITS)).astype("int64"))

    rolled = np.zeros(len(text), "uint64")
    for n in range(1, 5):
        rolled[: len(text) - n + 1] = rolled[: len(text) - n + 1] * np.uint64(1_000_003) + text[n - 1 :] + np.uint64(1)
        if n < 4:
            at = np.flatnonzero(room >= n)
            add(n, at, rolled[at])
        long = sizes - 2 >= n
        add(10 + n, starts[long] + 1, rolled[starts[long] + 1])
        add(20 + n, ends[long] - 1 - n, rolled[ends[long] - 1 - n])
    listed = [(k, lexicon[w]) for k, w in enumerate(words) if w in lexicon]
    if listed:
        number, own = np.array(listed, "int64").T
        add(30, starts[number], own.astype("uint64") << np.uint64(8))
    return np.concatenate(whose), np.concatenate(found)


def scores_of(weights: np.ndarray, whose: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
    """Label scores of ``n`` words: the sums of their features' weights."""
    return np.stack([np.bincount(whose, weights[found, k], n) for k in range(weights.shape[1])], axis=1)


def sample_rows(rows: DataFrame, size: int, longest: int, key: str = "_key", text: str = "_text") -> list:
    """At most ``size`` rows of at most ``longest`` characters, those with the smallest hashes of key and length.

    Hashes are ranked first, without the texts, so no task or driver gathers more texts than
    are returned.
    """
    short = rows.where(F.char_length(text).between(1, longest))
    hashed = short.withColumn("_h", F.xxhash64(F.col(key).cast("string"), F.char_length(text)))
    last = hashed.select("_h").orderBy("_h").limit(size).agg(F.max("_h")).first()[0]
    return hashed.where(F.col("_h") <= F.lit(last)).drop("_h").limit(size).collect() if last is not None else []


def train(
    docs: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = 1200,
    longest: int = 20_000,
) -> Model | None:
    """A model from a bounded sample of the labelled rows where ``learn`` holds; None if there are none.

    ``sample`` rows of at most ``longest`` characters bound what is gathered, whatever the
    corpus. A row's label is that of all its words.
    """
    labelled = docs.where(learn & F.col(lang).isNotNull()).select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang")
    )
    rows = [([w for w in map(letters, r["_text"].split()) if w], r["_lang"]) for r in sample_rows(labelled, sample, longest)]
    rows = sorted(r for r in rows if r[0])
    if not rows:
        return None
    langs = sorted({lang for _, lang in rows})
    counts: dict[str, Counter] = defaultdict(Counter)
    for words, own in rows:
        for word in set(words):
            counts[word][langs.index(own)] += 1
    lexicon = {w: c.most_common(1)[0][0] for w, c in counts.items() if c.total() >= 3 and c.most_common(1)[0][1] >= 0.9 * c.total()}
    places = {w: i for i, w in enumerate(counts)}
    whose, found = features(list(places), lexicon)
    items = np.fromiter((places[w] for words, _ in rows for w in words), "int64")
    lengths = np.array([len(words) for words, _ in rows])
    labels = np.repeat([langs.index(x) for _, x in rows], lengths)
    states = len(langs)

    def score(weights):
        return scores_of(weights, whose, found, len(places))[items]

    def pull(slope):
        by_word = [np.bincount(items, slope[:, k], len(places)) for k in range(states)]
        return np.stack([np.bincount(found, g[whose], FEATURES) for g in by_word], axis=1)

    weights, moves = crf.fit(score, pull, (FEATURES, states), labels, lengths, rounds=25, rate=0.05)
    return Model(langs, weights.astype("float32"), moves, lexicon)


_WORDS_AT_ONCE = 16_384


class _Scores(dict):
    """Row numbers of tokens in ``table``, which has their label scores; row 0 is for tokens without a letter."""

    def __init__(self, model: Model):
        self.model = model
        self.table = np.zeros((1, len(model.langs)), "float32")

    def learn(self, tokens: set[str]) -> None:
        """Add the tokens that are new."""
        own = {t: letters(t) for t in tokens if t not in self}
        words = list(dict.fromkeys(w for w in own.values() if w))
        if words:
            places = {w: k + len(self.table) for k, w in enumerate(words)}
            # The features of many words at once would take far more room than their scores.
            parts = (words[at : at + _WORDS_AT_ONCE] for at in range(0, len(words), _WORDS_AT_ONCE))
            new = [scores_of(self.model.weights, *features(part, self.model.lexicon), len(part)).astype("float32") for part in parts]
            self.table = np.concatenate([self.table, *new])
            self.update((t, places[w] if w else 0) for t, w in own.items())
        else:
            self.update(dict.fromkeys(own, 0))


def identify(
    docs: DataFrame,
    model: Model | None,
    key: str = "doc_id",
    text: str = "text",
    keep: dict[str, Column] | None = None,
    keep_text: str | None = None,
    block_words: int = 150_000,
    cache_words: int = 200_000,
) -> DataFrame:
    """Per row: key, lang_pred, score, certainty, and ``runs``, the stretches of words of one language in order.

    The language with most of the words' probability is predicted; ``score`` is its mean over
    the words, ``certainty`` the mean of each word's best probability, whatever its language. A null text, one without a letter, and any text without a model is ``und``
    with score and certainty 0. Repeated rows are returned each; other columns are ignored unless named in
    ``keep``, and the text is returned as ``keep_text`` if that is named. A worker holds ``block_words``
    words or one text at a time, and forgets its cached words when they are more than
    ``cache_words``. Neither changes a result.
    """
    extra = keep or {}
    kept = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), *[c.alias(f"_keep_{n}") for n, c in extra.items()])
    names = [f"_keep_{n}" for n in extra]
    schema = ", ".join(
        [f"`{key}` {docs.schema[key].dataType.simpleString()}"]
        + [f"`{n}` {kept.schema[f'_keep_{n}'].dataType.simpleString()}" for n in extra]
        + ([f"`{keep_text}` string"] if keep_text else [])
        + ["lang_pred string", "score double", "certainty double", "runs array<struct<lang: string, words: int>>"]
    )
    types = arrow_types(schema)

    def run(batches):
        forget_words()
        cache = _Scores(model) if model else None
        moves = model.moves.astype("float32") if model else None

        def labelled(block):
            tokens = [t for _, own in block for t in own]
            cache.learn(set(tokens))
            ids = np.fromiter(map(cache.__getitem__, tokens), "int64", len(tokens))
            ends = np.cumsum([len(own) for _, own in block])
            before = np.concatenate([[0], np.cumsum(ids > 0)])
            lengths = before[ends] - before[np.concatenate([[0], ends[:-1]])]
            shares, _ = crf.marginals(cache.table[ids[ids > 0]], lengths, moves, pairs=False)
            at = 0
            for (own, _), n in zip(block, lengths.tolist()):
                mine = shares[at : at + n]
                at += n
                if not n:
                    yield (*own, NONE, 0.0, 0.0, [])
                    continue
                share = mine.mean(axis=0, dtype="float64")
                best = int(share.argmax())
                path = mine.argmax(axis=1)
                turns = np.flatnonzero(np.diff(path, prepend=-1))
                sizes = np.diff(turns, append=n).tolist()
                runs = [{"lang": model.langs[path[i]], "words": k} for i, k in zip(turns.tolist(), sizes)]
                certainty = min(1.0, float(mine.max(axis=1).mean(dtype="float64")))
                yield (*own, model.langs[best], min(1.0, float(share[best])), certainty, runs)

        def every():
            nonlocal cache
            block, held = [], 0
            for columns in columns_of(batches):
                for at, whole in enumerate(columns["_text"]):
                    own = (columns["_key"][at], *[columns[n][at] for n in names], *([whole] if keep_text else []))
                    if model is None:
                        yield (*own, NONE, 0.0, 0.0, [])
                        continue
                    block.append((own, (whole or "").split()))
                    held += len(block[-1][1])
                    if held >= block_words:
                        yield from labelled(block)
                        block, held = [], 0
                        if len(cache) > cache_words:
                            cache = _Scores(model)
            if block:
                yield from labelled(block)

        try:
            yield from record_batches(types, every(), 1024)
        finally:
            cache = None
            release()

    return kept.mapInArrow(run, schema)
