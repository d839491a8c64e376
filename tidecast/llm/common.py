"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.session import scratch_dir

#: White space that separates words; every contract of this subpackage uses it.
SPACE = r"[\x20\x09-\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_UPPER_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage: what is read from the result is not computed again, and a lost
    executor costs a read, not a new run of the plan. So the shuffle files of the write go with its end.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    was = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete the files of ``staged`` tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            location = spark._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def number_rows(df: DataFrame, groups: list[str], order: list[str], name: str, part: str = "_part") -> DataFrame:
    """Gapless numbers from 0 within each group, for a staged ``df`` whose ``part`` names the task that wrote a row.

    Rows are ranked within (group, part) and offset by the counts of earlier parts, so no
    task ever holds a whole group, however hot it is. ``part`` is dropped.
    """
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*groups, part).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*groups, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*groups, part).orderBy(*order)))
    return (
        ranked.join(offsets, [*groups, part])
        .withColumn(name, (F.col("_rank") - 1 + F.col("_before")).cast("long"))
        .drop("_rank", "_before", part)
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b): each node ``a`` but the least, with the least ``b``.

    Alternates the large star (each larger neighbour is linked to a node's least one) and the
    small star (smaller neighbours are), which ends after about log^2 of the longest path.
    Every round is one written table; joins on a hot node are between a table of all edges
    and one row per node, which Spark can split.
    """

    def least(df: DataFrame) -> DataFrame:
        return df.groupBy("a").agg(F.min("b").alias("_least"))

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    def turned(df: DataFrame, a: str, b: str) -> DataFrame:
        return df.select(F.col(a).alias("a"), F.col(b).alias("b"))

    now = staged(turned(edges, "a", "b").where("a <> b"), "edges")
    was = None
    while (seen := state(now)) != was:
        was = seen
        both = now.union(turned(now, "b", "a"))
        large = both.join(least(both), "a").where("b > a").select("a", "b", F.least("a", "_least").alias("_to"))
        large = staged(turned(large, "b", "_to").where("a <> b").distinct(), "edges")
        joined = large.join(least(large), "a")
        small = turned(joined, "b", "_least").union(turned(joined, "a", "_least"))
        now = staged(small.where("a <> b").distinct(), "edges")
    return now


def crc_of_id(key: str) -> Column:
    """Unsigned crc32 of an id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def ascii_lower(text: str) -> bytes:
    """UTF-8 bytes with A-Z, and no other letter, in lower case."""
    return text.encode("utf-8", "replace").translate(_UPPER_TO_LOWER)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class WordIds(dict):
    """Token ids by text unit, as little-endian unsigned 32-bit integers, from a byte-level tokenizer.

    The new units of some texts are encoded in one call, with a separator between them that has
    a token of its own. Units of Latin letters alone are one word to the tokenizer's pattern, so
    they are handed to its merges without the pattern. A text with a string that the tokenizer
    takes for a special token is encoded whole. Two generations of at most ``limit`` units
    bound the memory; a unit that leaves is encoded again when it returns, so the ids never
    depend on the bound.
    """

    def __init__(self, path: str, limit: int = 200_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.old: dict[str, bytes] = {}
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.starts = {t[:2] for t in special}
        self.special = re.compile("|".join(map(re.escape, special)), re.IGNORECASE).search
        self.keeps_space = keeps_space = len(self._ids("\n")) > 0
        # A line break where the tokenizer keeps white space, else a digit, which stands alone in its pattern.
        self.between = "\n" if keeps_space else " 0 "
        self.mark = self._ids("\n" if keeps_space else "0")[0]
        self.fits = re.compile(r" ?\S(?:[^\n]*\S)?" if keeps_space else r" ?[^\s0](?:[^\n0]*[^\s0])?").fullmatch
        self.letters = _byte_letters()
        letters = re.compile(f" ?{_LATIN_LETTER}+").fullmatch
        self.plain = letters if keeps_space else lambda unit: unit.islower() and unit[0] != " " and letters(unit)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Split(self.letters[10], "isolated")
        self.stop = self.merges.encode(self.letters[10], add_special_tokens=False).ids

    def _ids(self, text: str):
        import numpy as np

        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _words(self, words: list[str]):
        """The ids of plain words, with the id of a line break between them."""
        import numpy as np

        spelled = "\n".join(words).encode().decode("latin-1").translate(self.letters)
        return np.array(self.merges.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")

    def learn(self, new: set[str]) -> dict[str, bytes]:
        """The ids of units that are not among the latest."""
        found = {u: self.old[u] for u in new if u in self.old} if self.old else {}

        def split(joint: list[str], ids, mark: int) -> None:
            stops = (ids == mark).nonzero()[0].tolist()
            if len(stops) == len(joint) - 1:
                raw = ids.tobytes()
                spans = zip([0, *[4 * x + 4 for x in stops]], [*[4 * x for x in stops], len(raw)])
                found.update(zip(joint, [raw[a:b] for a, b in spans]))

        words = [u for u in new if u not in found and self.plain(u)] if len(self.stop) == 1 else []
        if words:
            split(words, self._words(words), self.stop[0])
        joint = [u for u in new if u not in found and self.fits(u)]
        if joint:
            split(joint, self._ids(self.between.join(joint)), self.mark)
        for unit in new:
            if unit not in found:
                found[unit] = self._ids(unit).tobytes()
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self.update(found)
        return found

    def encode_all(self, texts: Iterable[str], block: int = 400_000):
        """The ids of each whole text; equal to encoding it in one call. About ``block`` characters are held at once."""
        source = iter(texts)
        while True:
            held, size = [], 0
            for text in source:
                held.append(text)
                size += len(text)
                if size >= block:
                    break
            if not held:
                return
            cuts = [[] if any(s in t for s in self.starts) and self.special(t) else units(t, self.keeps_space) for t in held]
            known = [list(map(self.get, cut)) for cut in cuts]
            missing = [[at for at, ids in enumerate(own) if ids is None] for own in known]
            found = self.learn({cut[at] for cut, places in zip(cuts, missing) for at in places})
            for text, cut, own, places in zip(held, cuts, known, missing):
                for at in places:
                    own[at] = found[cut[at]]
                yield b"".join(own) if cut or not text else self._ids(text).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of one whole text."""
        return next(self.encode_all([text]))

    def forget(self) -> None:
        """Give the memory of all units back."""
        self.clear()
        self.old = {}
        release()


_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_LATIN_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]"
#: A comma or stop that touches anything but Latin letters and digits before it, or another mark behind it, is not cut off.
_LATIN = "[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]"
_MARKS = re.compile(rf"[.,](?:(?<!{_LATIN}[.,])|[^\w\s]|_)")


def units(text: str, keeps_space: bool) -> list[str]:
    """A text cut where the tokenizers' own patterns never join characters, so that units can be encoded one by one.

    That is around each lone line break, before each lone space, and before a comma or stop
    that follows a letter or digit. Runs of white space stay inside a unit. For a tokenizer
    that drops white space and case, the units have neither.
    """
    flat = text.replace("\n", " ")
    # A space is the only printable white space.
    if not flat.isprintable() or "  " in flat or " " in (flat[:1], flat[-1:]):
        return _CUT.split(text)
    marks = not _MARKS.search(text)
    if keeps_space:
        if marks:
            text = text.replace(",", "\0,").replace(".", "\0.")
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
    if "\u03a3" not in flat and "\u0130" not in flat:
        flat = flat.lower()
    if marks:
        flat = flat.replace(",", " ,").replace(".", " .")
    return flat.split()


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of this worker process. It keeps its units for the stage's next task, and until ``forget_words``."""
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def forget_words() -> None:
    """Drop the units of all tokenizers; what works on other things in a reused worker calls this first."""
    for tokenizer in _WORD_IDS.values():
        if tokenizer or tokenizer.old:
            tokenizer.forget()


def release() -> None:
    """Give memory that was freed back to the system: workers are reused, and the next stage has other needs."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    ctypes.CDLL(None).malloc_trim(0)


def arrow_types(schema: str):
    """The Arrow schema of a schema string; needs the driver's session."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def record_batches(types, rows: Iterable[tuple], size: int = 4096):
    """Arrow batches of ``size`` rows each, as the rows come."""
    import pyarrow as pa

    source = iter(rows)
    while block := list(itertools.islice(source, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*block), types)], schema=types)


def columns_of(batches, size: int = 256):
    """The columns of Arrow batches as lists by name, at most ``size`` rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            yield {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}


def map_rows(
    df: DataFrame, schema: str, rows: Callable[[dict[str, list]], Iterable[tuple]], size: int = 4096
) -> DataFrame:
    """``df`` through ``rows``, which gets the columns of some rows as lists and yields tuples of ``schema``."""
    types = arrow_types(schema)

    def run(batches):
        forget_words()
        try:
            yield from record_batches(types, (r for columns in columns_of(batches) for r in rows(columns)), size)
        finally:
            release()

    return df.mapInArrow(run, schema)
