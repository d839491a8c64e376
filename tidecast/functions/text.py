"""Text expressions. All are native column functions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

# Fixed values -------------------------------------------------------------------
# Whitespace as Unicode defines it, spelled out so every regex engine agrees.
WHITESPACE = r"[\t-\r\x1C-\x1F\x{85}\p{Z}]+"
WORD = r"[\p{L}\p{N}_]+"
# Ordered literal replacements for English contractions and clock times.
CONTRACTIONS = [
    ("cannot ", "can not "),
    ("n't ", " n't "),
    ("n 't ", " n't "),
    ("ca n't", "can't"),
    ("ai n't", "ain't"),
    ("'m ", " 'm "),
    ("'re ", " 're "),
    ("'s ", " 's "),
    ("'ll ", " 'll "),
    ("'d ", " 'd "),
    ("'ve ", " 've "),
    (" p . m .", "  p.m."),
    (" p . m ", " p.m "),
    (" a . m .", " a.m."),
    (" a . m ", " a.m "),
]
TYPOGRAPHIC = [("’", "'"), ("…", "...")]
# A small set of emoji names; anything else passes through unchanged.
EMOJI_NAMES = {
    "🚀": ":rocket:",
    "🔥": ":fire:",
    "👍": ":thumbs_up:",
    "👎": ":thumbs_down:",
    "😀": ":grinning_face:",
    "😂": ":face_with_tears_of_joy:",
    "😢": ":crying_face:",
    "🐂": ":ox:",
    "🐻": ":bear:",
    "💰": ":money_bag:",
    "📈": ":chart_increasing:",
    "📉": ":chart_decreasing:",
}
HTML_ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
]
IMAGE_MARKER = "Image Credits"
# --------------------------------------------------------------------------------


def replace_all(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements, applied in order."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def squeeze(text: Column) -> Column:
    """Runs of whitespace become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def tokens(text: Column, at_most: int | None = None) -> Column:
    """Whitespace tokens of a text, without empty ones; the first ``at_most``, without splitting the rest."""
    if at_most is None:
        return F.array_remove(F.split(text, WHITESPACE), "")
    return F.slice(F.array_remove(F.split(text, WHITESPACE, at_most + 2), ""), 1, at_most)


def words(df: DataFrame, column: str) -> Column:
    """The lower-case tokens of a text column, none for a null; an array column holds them already."""
    if isinstance(df.schema[column].dataType, ArrayType):
        return F.col(column)
    return tokens(F.lower(F.coalesce(F.col(column), F.lit(""))))


def mask_token(token: Column) -> Column:
    """Hide user names and links, name single emoji, keep everything else."""
    lowered = F.lower(token)
    names = F.create_map(*[F.lit(x) for pair in EMOJI_NAMES.items() for x in pair])
    return (
        F.when(token.startswith("@"), F.lit("@USER"))
        .when(lowered.startswith("http") | lowered.startswith("www"), F.lit("HTTPURL"))
        .otherwise(F.coalesce(F.try_element_at(names, token), token))
    )


def mask_tokens(text: Column) -> Column:
    """Masked tokens joined by single spaces."""
    return F.array_join(F.transform(tokens(text), mask_token), " ")


def normalize(text: Column) -> Column:
    """Clean a post: punctuation, masked tokens, contractions, spacing."""
    plain = F.replace(replace_all(text, TYPOGRAPHIC), F.lit("\r"), F.lit(" "))
    return squeeze(replace_all(mask_tokens(plain), CONTRACTIONS))


def _found(text: Column, pattern: str) -> Column:
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(F.size(hits) > 0, hits)


def mentions(text: Column) -> Column:
    """All ``@name`` in a text, or NULL when there is none."""
    return _found(text, "@" + WORD)


def hashtags(text: Column) -> Column:
    """All ``#tag`` in a text, or NULL when there is none."""
    return _found(text, "#" + WORD)


def cut_at(text: Column, marker: str = IMAGE_MARKER) -> Column:
    """The text before the first marker; the whole text if there is none."""
    return F.substring_index(text, marker, 1)


def trim_lines(text: Column, head: int = 1, tail: int = 2) -> Column:
    """Drop the first ``head`` and the last ``tail`` lines."""
    lines = F.split(text, "\n")
    kept = F.greatest(F.size(lines) - (head + tail), F.lit(0))
    return F.array_join(F.slice(lines, head + 1, kept), "\n")


def three_lines(text: Column) -> Column:
    """``struct(title, date, article)`` of a three-line block, otherwise NULL fields."""
    lines = F.split(text, "\n")
    whole = F.size(lines) == 3

    def part(i: int) -> Column:
        return F.when(whole, F.try_element_at(lines, F.lit(i)))

    return F.struct(part(1).alias("title"), part(2).alias("date"), part(3).alias("article"))


def _visible(html: Column) -> Column:
    broken = F.regexp_replace(html, r"(?i)<br\s*/?>", "\n")
    return F.trim(replace_all(_numbered(F.regexp_replace(broken, r"<[^>]*>", "")), HTML_ENTITIES))


def _numbered(html: Column) -> Column:
    """Numeric entities, decimal or hexadecimal, as the characters they stand for."""
    pattern = r"&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"
    codes = F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)))

    def shown(code: Column) -> Column:
        number = F.when(F.lower(code).startswith("x"), F.conv(F.substring(code, 2, 6), 16, 10)).otherwise(code)
        number = number.cast("long")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        letter = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        return F.when(valid, letter).otherwise("\ufffd")

    return F.aggregate(
        codes, html, lambda text, code: F.replace(text, F.concat(F.lit("&#"), code, F.lit(";")), shown(code))
    )


def page_headline(html: Column) -> Column:
    """Visible text of the first ``h1``."""
    return _visible(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1))


def page_paragraphs(html: Column) -> Column:
    """Visible text of every paragraph, one per line, up to the image credits.

    An opening ``<p>`` ends the paragraph before it, closed or not, so the page is
    split at the opening tags.
    """
    body = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", "")
    pieces = F.split(body, r"(?i)<p(?:\s[^>]*)?>")
    after = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    texts = F.transform(after, lambda p: _visible(F.regexp_replace(p, r"(?is)</p\s*>.*$", "")))
    return cut_at(F.array_join(texts, "\n"))
