"""Text expressions. All run in the JVM; none is a UDF."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tertulia.functions.wordlists import KEYWORDS, STOPWORDS

# Every character Python's str.strip() removes. Spark's one-argument trim removes U+0020 only.
WHITESPACE = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))
SPACE = r"[\s\x1c-\x1f]"
SPACES = rf"(?U){SPACE}+"
URL = r"(?U)http[^\s\x1c-\x1f]+|www[^\s\x1c-\x1f]+"
NONWORD = r"[^\p{L}\p{N}_]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove Unicode whitespace from both ends."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(strip(c), F.lit("")) == ""


def clean_tokens(
    c: Column | str, stopwords: Iterable[str] = STOPWORDS, min_chars: int = 3
) -> Column:
    """Lower-cased words without URLs, punctuation, stopwords and short words."""
    lowered = F.lower(_col(c))
    # Most texts hold no link: two substring probes are cheaper than the pattern.
    has_url = lowered.contains("http") | lowered.contains("www")
    words = F.split(F.when(has_url, F.regexp_replace(lowered, URL, "")).otherwise(lowered), NONWORD)
    stop = sorted(stopwords)
    if not stop:
        return F.filter(words, lambda w: F.length(w) >= min_chars)
    return F.filter(words, lambda w: (F.length(w) >= min_chars) & ~w.isin(stop))


def clean_text(
    c: Column | str, stopwords: Iterable[str] = STOPWORDS, min_chars: int = 3
) -> Column:
    """`clean_tokens` joined by one space; null becomes the empty string."""
    return F.coalesce(F.array_join(clean_tokens(c, stopwords, min_chars), " "), F.lit(""))


def has_keyword(c: Column | str, keywords: Iterable[str] = KEYWORDS) -> Column:
    """True if any keyword occurs as a substring (`ley` also hits `leyenda`)."""
    pattern = "|".join(re.escape(k) for k in dict.fromkeys(keywords))
    return _col(c).rlike(pattern) if pattern else F.lit(False)


def class_tags(c: Column | str, prefix: str = "tag-") -> Column:
    """Tags held in class tokens: `tag-paz-total` becomes `paz total`, joined by `, `."""
    tokens = F.filter(F.split(_col(c), SPACES), lambda t: t.startswith(prefix))
    words = F.transform(tokens, lambda t: F.replace(F.replace(t, F.lit(prefix), F.lit("")), F.lit("-"), F.lit(" ")))
    return F.coalesce(F.array_join(words, ", "), F.lit(""))


def distinct_tags(c: Column | str) -> Column:
    """Non-empty texts of an array, first occurrence order, joined by `, `."""
    texts = F.filter(F.transform(_col(c), strip), lambda t: t != "")
    return F.coalesce(F.array_join(F.array_distinct(texts), ", "), F.lit(""))


def absolute_url(c: Column | str, host: str) -> Column:
    """`http…` unchanged, anything else prefixed with the host."""
    href = F.coalesce(_col(c), F.lit(""))
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(host), href))


def first_non_empty(*cs: Column | str) -> Column:
    """First value that is neither null nor the empty string; `""` if there is none."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cs], F.lit(""))
