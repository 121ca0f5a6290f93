"""Text column functions (strip, word count, normalise, pre-tokenise,
detokenise, n-grams).  All but ``normalize_lower_python`` are JVM
expressions."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.config import SPECIAL_TOKENS

# --- fixed values -------------------------------------------------------------
# The code points Python's str.isspace()/str.split() treat as whitespace:
# U+0009-000D, U+001C-001F, U+0020, U+0085, U+00A0, U+1680, U+2000-200A,
# U+2028, U+2029, U+202F, U+205F, U+3000 — as one Java regex class.
WS_CLASS = (r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
NON_WS_CLASS = (r"[^\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
                r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
# Pre-tokeniser: runs of word characters, or runs of characters that are
# neither word characters nor whitespace (Unicode classes).
PRETOKEN_PATTERN = r"(?U)\w+|[^\w\s]+"
# Detokeniser: drop one whitespace before these punctuation marks, then join
# a word character and an apostrophe-word across one whitespace.
DETOK_PUNCT_PATTERN = r"(?U)\s([.,!?'\":;])"
DETOK_CONTRACTION_PATTERN = r"(?U)(\w)\s('\w)"
# ------------------------------------------------------------------------------

# The same 29 whitespace code points as single characters (for translate).
WS_CHARS = "".join(chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                                    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def spaces_only(col) -> Column:
    """Map every whitespace code point to a plain space (character map, no
    regex): splitting the result on spaces and dropping empty pieces equals
    Python's ``str.split()``."""
    return F.translate(F.coalesce(_c(col), F.lit("")), WS_CHARS, " " * len(WS_CHARS))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_text(col) -> Column:
    """Python ``str.strip()`` with its full Unicode whitespace set.

    Trim positions come from the space-translated copy (code points map one
    to one), the substring from the original, so inner whitespace is kept."""
    c = _c(col)
    sp = _spaced(c)
    lead = F.length(sp) - F.length(F.ltrim(sp))
    return F.substring(c, lead + 1, F.length(F.trim(sp)))


def _spaced(col) -> Column:
    # every whitespace code point → ' ' (a character map): the regexes below
    # then use the trivial class [^ ] instead of the 29-code-point class,
    # measured ~1.7× faster with identical results
    return F.translate(_c(col), WS_CHARS, " " * len(WS_CHARS))


def word_count(col) -> Column:
    """Number of whitespace-separated words, ``len(s.split())`` (P2):
    maximal runs of non-whitespace characters.  NULL counts as 0."""
    return F.coalesce(F.regexp_count(_spaced(col), F.lit("[^ ]+")), F.lit(0))


def is_blank(col) -> Column:
    """True when NULL or only whitespace (NULL ≡ empty, see P3)."""
    return F.coalesce(~_spaced(col).rlike("[^ ]"), F.lit(True))


def whitespace_words(col) -> Column:
    """``s.split()`` as an array (empty array for blank / NULL).  Tokens
    contain no whitespace, so the translated text yields them unchanged."""
    return F.coalesce(F.regexp_extract_all(_spaced(col), F.lit("[^ ]+"), 0),
                      F.array().cast("array<string>"))


def pretokenize(col) -> Column:
    """Split into word runs and punctuation runs."""
    return F.regexp_extract_all(_c(col), F.lit(PRETOKEN_PATTERN), 0)


_CLASSES: dict = {}


def pretoken_classes(spark) -> tuple[str, str]:
    """``PRETOKEN_PATTERN`` for Python: the JVM says which characters it takes for word
    characters and whitespace, as its Unicode version is not Python's.  The first pattern,
    for texts without characters beyond U+FFFF, is many times faster."""
    app = spark.sparkContext.applicationId
    if app not in _CLASSES:
        points = [*range(0xD800), *range(0xE000, 0x110000)]
        s = F.col("s")
        for pattern, letter in ((r"(?U)\w", "w"), (r"(?U)\s", " "), (r"(?s)[^w ]", "o")):
            s = F.regexp_replace(s, pattern, letter)
        kinds = spark.createDataFrame([("".join(map(chr, points)),)], "s string").select(s).first()[0]
        runs = {x: [(points[m.start()], points[m.end() - 1]) for m in re.finditer(f"{x}+", kinds)] for x in "w "}

        def pattern(last):
            word, space = ("".join(f"\\U{a:08x}-\\U{min(z, last):08x}" for a, z in runs[x] if a <= last) for x in "w ")
            return f"[{word}]+|[^{word}{space}]+"
        _CLASSES.clear()
        _CLASSES[app] = pattern(0xFFFF), pattern(0x10FFFF)
    return _CLASSES[app]


def _nfkc_lower(s: str | None) -> str | None:
    if s is None:
        return None
    s = unicodedata.normalize("NFKC", s)
    # per-character lowercase: that of the whole string but for its rule of the final sigma
    return s.lower() if "Σ" not in s else "".join(ch.lower() for ch in s)


@F.pandas_udf(T.StringType())
def _nfkc_lower_udf(s: pd.Series) -> pd.Series:
    return s.map(_nfkc_lower)


def normalize_lower_python(col) -> Column:
    """NFKC then per-character lowercase (F1+F2) — Arrow-batched Python."""
    return _nfkc_lower_udf(_c(col))


#: Characters of whole texts that are cut at once.
READ_CHARS = 1 << 19
_TABLES: dict = {}


def _class_table(far: str) -> np.ndarray:
    """For each code point 1 (in a word), 2 (between words, but no whitespace) or 0 by the
    second pattern of ``pretoken_classes``."""
    if far not in _TABLES:
        table = np.zeros(0x110000, np.uint8)
        points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000))).astype("<u4")
        every, parts = points.tobytes().decode("utf-32-le"), far.index("]+|") + 2
        for kind, pattern in ((1, far[:parts]), (2, far[parts + 1:])):
            for m in re.finditer(pattern, every):
                table[points[m.start():m.end()]] = kind
        _TABLES.clear()
        _TABLES[far] = table
    return _TABLES[far]


def cutter(patterns: tuple[str, str]):
    """The function that normalises texts and cuts them with the patterns of
    ``pretoken_classes``, made in the worker: it gives (the words of all texts in order,
    how many each text has).  Words are cut out of the texts' bytes where the class of the
    code points changes; none is a Python string."""
    table = _class_table(patterns[1])

    def cut(norms: list) -> tuple[pa.Array, np.ndarray]:
        text = "\n".join(norms) + "\n"  # whitespace: no word crosses it
        kind = np.append(np.uint8(0), table[np.frombuffer(text.encode("utf-32-le"), "<u4")])
        change = kind[1:] != kind[:-1]
        starts, ends = (np.flatnonzero(change & (k != 0)) for k in (kind[1:], kind[:-1]))  # one behind each end
        size = np.diff(np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in norms)])))
        data, kind = np.frombuffer(text.encode(), np.uint8), kind[1:]
        if len(data) != len(kind):  # the place in ``data`` of each code point
            first = np.flatnonzero((data & 0xC0) != 0x80)
            width = np.diff(np.append(first, len(data)))
            starts, ends, kind = first[starts], first[ends], np.repeat(kind, width)
        bounds = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=bounds[1:])
        return pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data[kind != 0])), size

    def cut_all(texts) -> tuple[pa.Array, np.ndarray]:
        flat, size, norms, chars = [pa.array([], pa.string())], [np.zeros(0, np.int64)], [], 0

        def flush():
            for made, out in zip(cut(norms), (flat, size)):
                out.append(made)
            norms.clear()
        for text in texts:
            norms.append(_nfkc_lower(text) if text else "")
            chars += len(norms[-1])
            if chars >= READ_CHARS:
                flush()
                chars = 0
        if norms:
            flush()
        return pa.concat_arrays(flat), np.concatenate(size)
    return cut_all


ASCII_ONLY = r"^[\x00-\x7f]*$"


def normalize_frame(df, col: str, out: str):
    """Add ``out`` = NFKC+lowercase of ``col``.

    Pure-ASCII values are unchanged by NFKC and lower-case identically in the
    JVM; Python gets NULL for them and only works on the others.  There is one
    branch, so the input is evaluated once.
    """
    plain = F.col(col).rlike(ASCII_ONLY)
    return df.withColumn(out, F.coalesce(F.when(plain, F.lower(F.col(col))),
                                         normalize_lower_python(F.when(~plain, F.col(col)))))


def detokenize(tokens, specials=tuple(SPECIAL_TOKENS)) -> Column:
    """Drop special tokens, join with spaces, glue punctuation."""
    kept = F.filter(_c(tokens), lambda t: ~t.isin(*specials))
    s = F.array_join(kept, " ")
    s = F.regexp_replace(s, DETOK_PUNCT_PATTERN, "$1")
    return F.regexp_replace(s, DETOK_CONTRACTION_PATTERN, "$1$2")


def drop_special_tokens(tokens, specials=tuple(SPECIAL_TOKENS)) -> Column:
    """Remove special tokens, keeping duplicates and order."""
    return F.filter(_c(tokens), lambda t: ~t.isin(*specials))


# --- fixed values -------------------------------------------------------------
# "intl" tokenisation: space out punctuation not preceded / followed by a
# digit, space out every symbol, then split on whitespace.
INTL_RULES = [
    (r"(\P{N})(\p{P})", "$1 $2 "),
    (r"(\p{P})(\P{N})", " $1 $2"),
    (r"(\p{S})", " $1 "),
]
# ------------------------------------------------------------------------------


def intl_tokenize(col) -> Column:
    """International tokenisation used by the case-sensitive BLEU."""
    s = _c(col)
    for pat, rep in INTL_RULES:
        s = F.regexp_replace(s, pat, rep)
    return whitespace_words(s)


NGRAM_SEP = "\u0001"


def ngrams(tokens, n) -> Column:
    """All contiguous n-grams of an array, joined with U+0001 (F15); ``n`` is a
    number or a column."""
    t = _c(tokens)
    n = n if isinstance(n, Column) else F.lit(n)
    return F.when(
        F.size(t) >= n,
        F.transform(F.sequence(F.lit(1), F.size(t) - n + 1),
                    lambda i: F.array_join(F.slice(t, i, n), NGRAM_SEP)),
    ).otherwise(F.array().cast("array<string>"))
