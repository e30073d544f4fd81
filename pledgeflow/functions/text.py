"""Text cleaning expressions."""

from __future__ import annotations

import contextlib
import html
import string
import sys
import unicodedata

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def single_line(text: Column) -> Column:
    """CR, LF and TAB become spaces, ends are trimmed."""
    return F.trim(F.regexp_replace(text, "[\\r\\n\\t]", " "))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "\\s+", " "))


def label(name: Column) -> Column:
    """``amount_raised`` -> ``Amount raised``."""
    return F.concat(F.upper(F.substring(name, 1, 1)), F.replace(F.substr(name, F.lit(2)), F.lit("_"), F.lit(" ")))


def strip_comments(page: Column) -> Column:
    """Drop HTML comments, badly closed ones first."""
    return F.regexp_replace(F.regexp_replace(page, "(?s)<!--.*?--!>", ""), "(?s)<!--.*?-->", "")


def utf8_bytes(text: Column) -> Column:
    """Bytes of a text that was read as latin1 although it was UTF-8."""
    return F.encode(text, "ISO-8859-1")


def redecode(text: Column) -> Column:
    """Read latin1-decoded text as UTF-8 again; undecodable bytes are dropped."""
    repaired = F.make_valid_utf8(utf8_bytes(text).cast("string"))
    return F.replace(repaired, F.lit("\ufffd"), F.lit(""))


def decodes(text: Column) -> Column:
    return F.is_valid_utf8(utf8_bytes(text).cast("string"))


def token_suffix(classes: Column, suffix: str) -> Column:
    """Class tokens ending in ``suffix``, without it, joined by spaces; NULL when none."""
    hits = F.filter(F.split(classes, " "), lambda c: c.endswith(suffix))
    bare = F.transform(hits, lambda c: F.substr(c, F.lit(1), F.length(c) - len(suffix)))
    return F.when(F.size(bare) > 0, F.array_join(bare, " "))


def split_location(text: Column) -> Column:
    """Split on ``, `` but keep a piece ending in `` of`` with the one before it."""
    return F.split(text, ", (?![^,]* of(?:,|$))")


def or_none(value: Column) -> Column:
    """Text for an export in which a missing value reads ``none``."""
    return F.coalesce(value.cast("string"), F.lit("none"))


# text standing in for newline, pipe and carriage return in one-line records
_NEWLINE, _PIPE, _RETURN = "\x03", "\x04", "\x05"


def encode_controls(text: Column) -> Column:
    return F.translate(text, "\n|\r", _NEWLINE + _PIPE + _RETURN)


def decode_controls(text: Column) -> Column:
    """Newlines and pipes come back, carriage returns are dropped."""
    return F.translate(text, _NEWLINE + _PIPE + _RETURN, "\n|")


# fixed values: what a letter after a backslash stands for, and how many hex digits follow one
_LETTERS = {"a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v", "'": "'", '"': '"', "\n": ""}
_HEX_DIGITS = {"x": 2, "u": 4, "U": 8}


def _number_escape(part: str) -> tuple[str, int] | None:
    """Character and length of a hex, octal or named escape at the start of ``part``."""
    size = _HEX_DIGITS.get(part[0], 0)
    digits = part[1 : 1 + size]
    if size and len(digits) == size and set(digits) <= set(string.hexdigits):
        code = int(digits, 16)
        return (chr(code), 1 + size) if code < 0x110000 else None
    octal = len(part[:3]) - len(part[:3].lstrip(string.octdigits))
    if octal:
        return chr(int(part[:octal], 8)), octal
    if part.startswith("N{") and "}" in part:
        name = part[2 : part.index("}")]
        with contextlib.suppress(KeyError):
            return unicodedata.lookup(name), len(name) + 3
    return None


def _unescaped(text: str) -> str:
    """Walk the parts between backslashes: an empty part means that the backslash itself was escaped."""
    parts = iter(text.split("\\"))
    out = [next(parts)]
    for part in parts:
        if not part:
            out.append("\\" + next(parts, ""))
        elif part[0] in _LETTERS:
            out.append(_LETTERS[part[0]] + part[1:])
        elif found := _number_escape(part):
            out.append(found[0] + part[found[1] :])
        else:
            out.append("\\" + part)
    # escapes may spell a character as a surrogate pair
    return "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")


@F.pandas_udf(T.StringType())
def _literal(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: None if text is None else html.unescape(_unescaped(text)))


# a run of four-digit escapes, a two-digit one, any other escape, text without one, a backslash at the end
_TOKENS = r"(?:\\u[0-9A-Fa-f]{4})+|\\x[0-9A-Fa-f]{2}|\\[\s\S]|[^\\]+|\\"
# left to Python: long, octal and named escapes, and halves of a surrogate pair without the other
_RARE_ESCAPES = r"\\[UN0-7]|(?<!\\u[dD][89abAB][0-9A-Fa-f]{2})\\u[dD][c-fC-F]|\\u[dD][89abAB][0-9A-Fa-f]{2}(?!\\u[dD][c-fC-F])"
# fixed values: entities decoded without Python, the ampersand last; all others that may be one are left to it
_ENTITIES = {"&quot;": '"', "&lt;": "<", "&gt;": ">", "&#39;": "'", "&#x27;": "'", "&amp;": "&"}
_RARE_ENTITIES = "&(?!(?:" + "|".join(e[1:-1] for e in _ENTITIES) + ");)[A-Za-z#]"


def _decoded(text: Column) -> Column:
    """Backslash escapes of up to four hex digits and of single letters, decoded in the JVM."""
    letters = F.create_map(*[F.lit(x) for pair in _LETTERS.items() for x in pair], F.lit("\\"), F.lit("\\"))

    def value(token: Column) -> Column:
        wide = F.decode(F.unhex(F.replace(token, F.lit("\\u"), F.lit(""))), "UTF-16BE")
        narrow = F.decode(F.unhex(F.substring(token, 3, 2)), "ISO-8859-1")
        letter = F.coalesce(F.try_element_at(letters, F.substring(token, 2, 1)), token)
        return (
            F.when(~token.startswith("\\") | (F.char_length(token) == 1), token)
            .when(token.startswith("\\u") & (F.char_length(token) > 2), wide)
            .when(token.startswith("\\x") & (F.char_length(token) > 2), narrow)
            .otherwise(letter)
        )

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0)), value), "")


def script_literal(text: Column) -> Column:
    """Decode the backslash escapes and HTML entities of a script string literal.

    A text with neither is returned as it is; unknown escapes stay. Common escapes and entities are
    decoded in the JVM; only a text with a rare one is handed to Python, which is never given the others.
    """
    escaped, common = F.contains(text, F.lit("\\")), ~text.rlike(_RARE_ESCAPES)
    plain = F.when(escaped & common, _decoded(text)).when(~escaped, text)
    simple = plain.isNotNull() & ~plain.rlike(_RARE_ENTITIES)
    out = plain
    for entity, character in _ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(character))
    return F.when(simple, out).otherwise(_literal(F.when(~F.coalesce(simple, F.lit(False)), text)))
