"""Scalar text expressions.

Every function takes a Column (or a column name) and returns a Column made of
built-in Spark SQL expressions, so it stays inside the JVM and also runs on a
streaming DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from reportlens.functions import lexicons as lx

_BLANK = r"(?U)\s+"
_WORD = r"(?U)\S+"
_EDGE_PUNCTUATION = r"^[\s,;:.]+|[\s,;:.]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def total(columns) -> Column:
    """Sum of a Python list of columns (0 for an empty list)."""
    return reduce(lambda a, b: a + b, columns, F.lit(0))


# ---------------------------------------------------------------- whitespace

def strip(c) -> Column:
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def squeeze(c) -> Column:
    """Runs of white space become one blank, the edges are stripped."""
    return F.btrim(F.regexp_replace(_col(c), _BLANK, " "))


def is_blank(c) -> Column:
    return ~F.coalesce(_col(c), F.lit("")).rlike(r"(?U)\S")


# -------------------------------------------------------------------- counts

def words(c) -> Column:
    """White-space tokens as an array (empty for null)."""
    return F.regexp_extract_all(_text(c), F.lit(_WORD), F.lit(0))


def word_count(c) -> Column:
    return F.regexp_count(_text(c), F.lit(_WORD))


def char_count(c) -> Column:
    return F.length(_text(c))


def sentence_count(c, lang: str = "en") -> Column:
    """Non-blank pieces between ``.`` (en) or ``. ! ?`` (fr)."""
    sep = r"\." if lang == "en" else r"[.!?]"
    return F.size(F.filter(F.split(_text(c), sep), lambda s: s.rlike(r"(?U)\S")))


def avg_sentence_len(n_words, n_sentences) -> Column:
    return _col(n_words) / F.greatest(_col(n_sentences), F.lit(1))


def sentences(c, mode: str = "dot") -> Column:
    """Stripped non-blank sentences; ``dot`` splits on ``.``, ``punct`` after
    ``. ! ?`` followed by white space (the mark stays with its sentence)."""
    sep = r"\." if mode == "dot" else r"(?U)(?<=[.!?])\s+"
    pieces = F.transform(F.split(_text(c), sep), strip)
    return F.filter(pieces, lambda s: s != "")


# ------------------------------------------------------------- normalisation

def combine_text(a, b, strip_edges: bool = False) -> Column:
    joined = F.concat(_text(a), F.lit(" "), _text(b))
    return strip(joined) if strip_edges else joined


def normalize_en(c) -> Column:
    """Tags out, white space squeezed, ``x-XXXX`` -> ``x-ray`` in any case, then
    the upper-case placeholder ``XXXX`` -> ``[REDACTED]``."""
    t = F.regexp_replace(_text(c), "<[^>]+>", "")
    t = squeeze(t)
    t = F.regexp_replace(t, "(?i)x-xxxx", "x-ray")
    return F.replace(t, F.lit("XXXX"), F.lit("[REDACTED]"))


def normalize_en_strict(c) -> Column:
    """Lower case, tags out, word-bounded placeholders, ``..`` collapsed, white
    space squeezed, punctuation trimmed at both ends."""
    t = F.regexp_replace(F.lower(_text(c)), "<[^>]+>", "")
    # Unicode word bounds are slow to test; most texts hold no placeholder.
    marked = F.regexp_replace(F.regexp_replace(t, r"(?U)\bx-xxxx\b", "x-ray"), r"(?U)\bxxxx\b", "[REDACTED]")
    t = F.when(F.contains(t, F.lit("xxxx")), marked).otherwise(t)
    t = F.regexp_replace(t, r"\.{2,}", ".")
    return F.regexp_replace(squeeze(t), _EDGE_PUNCTUATION, "")


def normalize_fr(c) -> Column:
    """White space squeezed, dots collapsed, typographic quotes -> ``'``,
    ``/`` -> ``. ``, stripped and lower-cased; accents are kept."""
    t = F.regexp_replace(_text(c), _BLANK, " ")
    t = F.regexp_replace(t, r"\.+", ".")
    t = F.translate(t, "’`", "''")
    return F.lower(F.btrim(F.replace(t, F.lit("/"), F.lit(". "))))


def normalize_fr_lines(c) -> Column:
    """``./`` starts a new line, blanks are squeezed per line, blank lines go,
    dots are collapsed, punctuation is trimmed at both ends, case is kept."""
    lines = F.split(F.regexp_replace(_text(c), r"\./", ".\n"), "\n")
    lines = F.transform(lines, lambda s: strip(F.regexp_replace(s, r"[ \t]+", " ")))
    t = F.array_join(F.filter(lines, lambda s: s != ""), "\n")
    t = F.regexp_replace(t, r"\.{2,}", ".")
    return F.regexp_replace(t, _EDGE_PUNCTUATION, "")


def has_placeholder(c) -> Column:
    return F.contains(F.upper(_text(c)), F.lit("XXXX"))


def none_to_empty(c) -> Column:
    """Null and any spelling of ``none`` become ``''``; the rest is stripped."""
    s = strip(_text(c))
    return F.when(F.lower(s) == "none", F.lit("")).otherwise(s)


# ------------------------------------------------------------ demographics

def parse_age(c, mode: str = "leading") -> Column:
    """``any``: first digits anywhere. ``leading``: digits at the start.
    ``bounded``: as leading, but null outside 0..120."""
    pattern = r"(\d+)" if mode == "any" else r"^\s*(\d+)"
    digits = F.regexp_extract(_text(c), pattern, 1)
    age = digits.try_cast("double")
    if mode == "bounded":
        return F.when(age <= 120, age)
    return age


def normalize_gender(c, mode: str = "initial") -> Column:
    """``initial``: upper-cased first letter if M or F. ``exact``: stripped
    value if M, F or O. Anything else is null."""
    if mode == "initial":
        g, allowed = F.upper(F.substring(_col(c).cast("string"), 1, 1)), ["M", "F"]
    else:
        g, allowed = strip(_col(c).cast("string")), ["M", "F", "O"]
    return F.when(g.isin(allowed), g)


# ---------------------------------------------------------------- tokens

def tokens(c, lang: str = "en", stop=None, min_len: int = 3) -> Column:
    """Vocabulary tokens. ``en`` keeps runs of A-Z letters, ``fr`` also the
    Latin-1 accented ones, both lower-cased, at least ``min_len`` long and
    outside the stop list. ``raw`` is a plain lower-case split."""
    lowered = F.lower(_text(c))
    if lang == "raw":
        return F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))
    letters = "a-z" if lang == "en" else "a-zA-ZÀ-ÿ"
    stop = stop if stop is not None else lx.stop_words(lang)
    found = F.regexp_extract_all(lowered, F.lit(f"[{letters}]{{{min_len},}}"), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(list(stop))) if stop else found


# ------------------------------------------------------- lexicon matching
#
# These take the *name* of a column of lower-cased text. A lexicon of dozens of
# terms becomes one SQL expression, parsed once, instead of hundreds of Column
# objects; the text column is bound once by the projection that makes it.

def lowered(c) -> Column:
    return F.lower(_text(c))


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _has(low: str, term: str) -> str:
    return f"contains(`{low}`, {_lit(term)})"


def _any(low: str, terms) -> str:
    return "(" + " OR ".join(_has(low, t) for t in terms) + ")"


def _occurrences(low: str, term: str) -> str:
    return f"((length(`{low}`) - length(replace(`{low}`, {_lit(term)}, ''))) div {len(term)})"


def term_hits(low: str, terms) -> Column:
    """How many of the terms occur, as substrings."""
    return F.expr(" + ".join(f"int({_has(low, t)})" for t in terms))


def occurrences(low: str, term: str) -> Column:
    """Non-overlapping occurrences of one term."""
    return F.expr(f"int({_occurrences(low, term)})")


def term_occurrences(low: str, terms) -> Column:
    return F.expr("int(" + " + ".join(_occurrences(low, t) for t in terms) + ")")


def has_any(low: str, terms) -> Column:
    return F.expr(_any(low, terms))


def term_weight_max(low: str, weights: dict) -> Column:
    """Largest weight among the matching terms, 0 if none matches."""
    arms = [f"WHEN {_any(low, [t for t, w in weights.items() if w == level])} THEN {level}"
            for level in sorted(set(weights.values()), reverse=True)]
    return F.expr(f"CASE {' '.join(arms)} ELSE 0 END")


def term_weight_sum(low: str, weights: dict) -> Column:
    return F.expr(" + ".join(f"int({_has(low, t)}) * {w}" for t, w in weights.items()))


def first_category(low: str, categories: dict, default: str = "Other") -> Column:
    """First category, in the order given, with a matching keyword."""
    arms = " ".join(f"WHEN {_any(low, kws)} THEN {_lit(name)}" for name, kws in categories.items())
    return F.expr(f"CASE {arms} ELSE {_lit(default)} END")


def category_count(low: str, categories: dict) -> Column:
    return F.expr(" + ".join(f"int({_any(low, kws)})" for kws in categories.values()))


def all_categories(low: str, categories: dict) -> Column:
    """Array of every matching category in list order (empty if none)."""
    marks = ", ".join(f"CASE WHEN {_any(low, kws)} THEN {_lit(name)} END" for name, kws in categories.items())
    return F.expr(f"array_compact(array({marks}))")


def join_labels(labels, default: str = "Other") -> Column:
    return F.when(F.size(_col(labels)) > 0, F.array_join(_col(labels), "|")).otherwise(default)


def is_normal(labels) -> Column:
    """A ``|``-joined label string that mentions normal and has a single label."""
    t = _text(labels)
    return F.contains(F.lower(t), F.lit("normal")) & ~F.contains(t, F.lit("|"))


def bucket_classes(c, keep, default: str = "Other") -> Column:
    return F.when(_col(c).isin(list(keep)), _col(c)).otherwise(default)


def clip(c, lo, hi) -> Column:
    return F.least(F.greatest(_col(c), F.lit(lo)), F.lit(hi))
