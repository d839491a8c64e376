"""Words cut into known pieces: the longest known piece first, down to single characters.

A vocabulary is a count, not a trained tokenizer: the most frequent words, and every character. A word
outside it is cut from the left into the longest pieces that are known, so only a character that
was never seen has the unknown id. A piece inside a word has another id than one that begins a word, and
ids give their words back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidecast.functions import text
from tidecast.operators.sentiment import FIRST_WORD_ID, PAD_ID, SEPARATOR_ID, SEQUENCE_LENGTH, UNKNOWN_ID

#: Texts that are encoded at once.
_ROWS = 256


def build_pieces(df: DataFrame, words: int, text_col: str = "content") -> DataFrame:
    """piece, n, piece_id: all characters and the ``words`` most frequent longer words; ties go by the piece.

    Words are counted before they are cut to characters, so a frequent word is cut once.
    """
    counted = df.select(F.explode(text.tokens(F.lower(text_col))).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    letters = counted.select(F.explode(F.split("piece", "")).alias("piece"), "n").where("piece <> ''")
    letters = letters.groupBy("piece").agg(F.sum("n").alias("n"))
    longer = counted.where(F.char_length("piece") > 1).orderBy(F.desc("n"), "piece").limit(words)
    # Numbered over the vocabulary alone.
    position = F.row_number().over(Window.orderBy(F.char_length("piece") > 1, F.desc("n"), "piece"))
    return letters.unionByName(longer).select("piece", "n", (position - 1 + FIRST_WORD_ID).cast("long").alias("piece_id"))


def cut(word: str, ids: dict[str, int], longest: int) -> list[int]:
    """The ids of a word's pieces; those inside the word are moved up by the number of pieces."""
    found, at = [], 0
    while at < len(word):
        for size in range(min(longest, len(word) - at), 0, -1):
            known = ids.get(word[at : at + size])
            if known is not None:
                break
        found.append(UNKNOWN_ID if known is None else known + (len(ids) if at else 0))
        at += size
    return found


def encode_pieces(
    df: DataFrame,
    row_id: str,
    vocabulary: DataFrame,
    length: int = SEQUENCE_LENGTH,
    text_col: str = "content",
    pair_col: str | None = None,
    most: int = 200_000,
) -> DataFrame:
    """(row_id, input_ids, attention_mask) of fixed length: the pieces of the text, cut to it, and pads.

    A pair text follows a separator and keeps its pieces; the first text gives way. A null text
    has none. The vocabulary travels with the tasks; one of more than ``most`` pieces raises.
    """
    rows = vocabulary.select("piece", "piece_id").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} pieces")
    ids = {r["piece"]: r["piece_id"] for r in rows}
    first = text.tokens(F.lower(text_col), length)
    second = text.tokens(F.lower(pair_col), length) if pair_col else F.lit(None).cast("array<string>")
    narrow = df.select(row_id, first.alias("_first"), second.alias("_second"))
    numbers = F.array(F.lit(0).cast("long"))
    schema = narrow.select(row_id, numbers.alias("input_ids"), numbers.alias("attention_mask")).schema
    return narrow.mapInArrow(_encoder(ids, to_arrow_schema(schema), length, pair_col is not None), schema)


def _encoder(ids: dict[str, int], types, length: int, paired: bool) -> Callable:
    """A function over Arrow batches of a row's id, words and words of its pair text, ``_ROWS`` of them at a time."""
    longest = max(map(len, ids), default=1)

    def run(batches):
        import pyarrow as pa

        known: dict[str, list[int]] = {}

        def pieces(words: list[str] | None) -> list[int]:
            found: list[int] = []
            for word in words or ():
                if len(found) >= length:
                    break
                if word not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[word] = cut(word, ids, longest)
                found += known[word]
            return found[:length]

        for batch in (whole.slice(at, _ROWS) for whole in batches for at in range(0, whole.num_rows, _ROWS)):
            rows = []
            for own, pair in zip(batch.column("_first").to_pylist(), batch.column("_second").to_pylist()):
                if not paired:
                    rows.append(pieces(own))
                else:
                    end = pieces(pair)[: length - 1]
                    rows.append([*pieces(own)[: length - 1 - len(end)], SEPARATOR_ID, *end])
            masks = [[1] * len(x) + [0] * (length - len(x)) for x in rows]
            rows = [x + [PAD_ID] * (length - len(x)) for x in rows]
            columns = [batch.column(types.names[0]), pa.array(rows, types.field("input_ids").type), pa.array(masks, types.field("attention_mask").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=types)

    return run


def words_of(input_ids: list[int], pieces: dict[int, str]) -> list[str]:
    """The words that ids stand for; an unknown character is ``\\ufffd``."""
    words: list[str] = []
    for number in input_ids:
        if number in (PAD_ID, SEPARATOR_ID):
            continue
        inside = number - len(pieces) in pieces and number not in pieces
        piece = pieces[number - len(pieces) if inside else number] if number != UNKNOWN_ID else "\\ufffd"
        if inside and words:
            words[-1] += piece
        else:
            words.append(piece)
    return words
