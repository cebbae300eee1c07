"""Text clean-up and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The literal replacements of the punctuation normaliser, in the
# order they are applied. Every one is a single left-to-right sweep, so runs of
# spaces are shortened and not always collapsed.
PUNCTUATION_STEPS = (
    ("-", " "),
    ("!", ""),
    ("[", " "),
    ("]", " "),
    (":", " "),
    (";", " "),
    ("(", " "),
    (")", " "),
    ("_", " "),
    ("   ", " "),
    ("  ", " "),
    ("    ", " "),
    (". ", "."),
)

# Where the id starts in a share url, and the url rewrite.
SHARE_URL_ID_START = 17
USER_URL_REWRITE = ("/c/", "/user/")

QUOTE_SEPARATOR = '","'


def _replace(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def normalise_punctuation(col: Column) -> Column:
    for old, new in PUNCTUATION_STEPS:
        col = _replace(col, old, new)
    return col


def clean_caption(col: Column) -> Column:
    """Newlines and double quotes become spaces."""
    return F.translate(col, '\n"', "  ")


def normalise_query(col: Column) -> Column:
    return _replace(col, "_", " ")


def repair_quotes(line: Column) -> Column:
    """Make one raw CSV line parse again: only field separators keep their quotes.

    The line has no trailing newline. Its first and last character are the outer
    quotes; every quote between them that is not part of a separator is text.
    """
    mark = "\u0001"
    inner = _replace(line, QUOTE_SEPARATOR, mark)
    inner = _replace(inner, '"', " ")
    inner = _replace(inner, mark, QUOTE_SEPARATOR)
    body = F.substring(inner, F.lit(2), F.length(inner) - 2)
    return F.concat(F.lit('"'), body, F.lit('"'))


def _minutes_seconds(seconds: Column) -> tuple[Column, Column]:
    value = seconds.cast("double")
    return F.floor(value / 60), F.floor(F.pmod(value, F.lit(60.0)))


def time_label(seconds: Column, padded: bool = True) -> Column:
    """``mm:ss`` or the unpadded ``m:s``; minutes go on past 60."""
    return F.format_string("%02d:%02d" if padded else "%d:%d", *_minutes_seconds(seconds))


def utf8(col: Column) -> Column:
    return F.decode(col, "UTF-8")


def normalise_url(col: Column) -> Column:
    """The rewritten url, or null for a percent-encoded (rejected) one."""
    return F.when(~col.contains("%"), _replace(col, *USER_URL_REWRITE))


def share_id(url: Column) -> Column:
    return F.substring(url, F.lit(SHARE_URL_ID_START + 1), F.length(url))


def cluster_key(label: Column, level: int = 1) -> Column:
    return F.concat(F.lit("c" * level), label.cast("string"))


def chunk_key(cluster_id: Column, chunk_no: Column) -> Column:
    return F.concat(cluster_id, F.lit("_b"), chunk_no.cast("string"))


def page_file_key(channel: Column, token: Column) -> Column:
    return F.concat(channel, F.lit("_"), token)
