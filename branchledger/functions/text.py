"""Text expressions (codes, names, units). Every function maps Column -> Column."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Report cells carry no-break spaces besides ASCII blanks.
BLANKS = " \t\n\r\f\v\u00a0"
WORD_BREAK = "\u0001 "


def norm_code(c: Column) -> Column:
    """Business code used in every group and join: upper case, no spaces."""
    return F.replace(F.upper(c), F.lit(" "), F.lit(""))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def strip_suffixes(c: Column, suffixes: Iterable[str]) -> Column:
    """Remove each suffix once, in the given order, trimming after each."""

    def cut(name: Column, suffix: Column) -> Column:
        kept = F.left(name, F.length(name) - F.length(suffix))
        return F.when(F.endswith(name, suffix), strip(kept)).otherwise(name)

    return F.aggregate(F.array(*[F.lit(s) for s in suffixes]), strip(c), cut)


def drop_name_tags(c: Column, tail_pattern: str, anywhere: str) -> Column:
    """Dashboard name: cut a trailing tag, then a literal tag wherever it stands."""
    return F.replace(F.regexp_replace(c, tail_pattern, ""), F.lit(anywhere), F.lit(""))


def _title(c: Column, word: str) -> Column:
    # initcap starts words after a space only, so a marked space goes before every letter
    # that follows another kind of break.
    marked = F.regexp_replace(c, rf"([^{word} ])(?=[{word}])", f"$1{WORD_BREAK}")
    return F.replace(F.initcap(marked), F.lit(WORD_BREAK), F.lit(""))


def title_letters(c: Column) -> Column:
    """Title case where any non-letter ends a word (``o'neil`` -> ``O'Neil``)."""
    return _title(c, r"\p{L}")


def title_words(c: Column) -> Column:
    """Title case where letters and digits belong to a word (SQL ``initcap``)."""
    return _title(c, r"\p{L}\p{N}")


def sentence_case(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def remove_all(c: Column, parts: Iterable[str]) -> Column:
    for part in parts:
        c = F.replace(c, F.lit(part), F.lit(""))
    return c


def unit_int(c: Column, units: Iterable[str]) -> Column:
    """``1.200.000VND`` -> 1200000, ``500ml`` -> 500; anything else -> null."""
    return remove_all(c, units).try_cast("int")


def swap_prefix(c: Column, old: str, new: str, width: int = 50) -> Column:
    """Replace a leading ``old`` only, on at most ``width`` characters."""
    return F.regexp_replace(F.substring(c.cast("string"), 1, width), f"^{re.escape(old)}", new)


def join_or_blank(a: Column, b: Column, sep: str) -> Column:
    """``a sep b`` with a null part read as an empty string."""
    return F.concat(F.coalesce(a, F.lit("")), F.lit(sep), F.coalesce(b, F.lit("")))


def split_pair(c: Column, sep: str) -> tuple[Column, Column]:
    """First and second part of ``a - b``; a missing part is null."""
    parts = F.split(c, re.escape(sep))
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def plain_text(text: str) -> str:
    """Driver-side de-accenting of a name (``Đăk Lăk`` -> ``Dak Lak``)."""
    text = text.replace("đ", "d").replace("Đ", "D")
    return "".join(ch for ch in unicodedata.normalize("NFD", text) if not unicodedata.combining(ch))


def _accented_pairs() -> tuple[str, str]:
    """Every precomposed Latin letter that de-accents to one ASCII letter."""
    accented = [chr(i) for i in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00))]
    pairs = [(ch, plain_text(ch)) for ch in accented]
    pairs = [(a, p) for a, p in pairs if len(p) == 1 and p.isascii() and a != p]
    return "".join(a for a, _ in pairs), "".join(p for _, p in pairs)


def deaccent(c: Column) -> Column:
    """De-accent data (header names go through ``plain_text`` on the driver)."""
    accented, plain = _accented_pairs()
    return F.translate(c, accented, plain)
