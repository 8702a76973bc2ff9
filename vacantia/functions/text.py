"""Text cleaning, matching and list handling."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from html.entities import html5

from pyspark.sql import Column, functions as F

NULL_MARK = "\u0000"


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it. In branches and lambdas Spark computes it each time."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def clean_text(c: Column) -> Column:
    """Collapse runs of white space and trim."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


# Every character that counts as white space.
WHITE_SPACE = ("\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
               "\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only spaces."""
    return F.trim(c, F.lit(WHITE_SPACE))


def normalise_title(c: Column) -> Column:
    """Lower-cased title reduced to letters (with Latin accents), digits and spaces."""
    return F.lower(F.regexp_replace(c, r"[^a-zA-Z0-9À-ɏ ]", ""))


def key_md5(*parts: Column) -> Column:
    """md5 of the parts joined by a bar. A NULL part keeps its place, so shifted parts do not collide."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit(NULL_MARK)) for p in parts]))


def found_names(lowered: Column, names: Sequence[str], values: Sequence[object] | None = None) -> Column:
    """Array of the names contained in an already lower-cased text, in list order.

    One comparison per name is written out instead of a lambda: a lambda would lower the text again
    for each name, and it is not compiled. Pass ``values`` to get them in place of the names.
    """
    values = names if values is None else values
    hits = [F.when(F.contains(lowered, F.lit(n.lower())), F.lit(v)) for n, v in zip(names, values, strict=True)]
    return F.array_compact(F.array(*hits))


def bounded(c: Column, max_chars: int | None) -> Column:
    """The whole text, or its first ``max_chars`` characters when a bound is asked for."""
    return c if max_chars is None else F.left(c, F.lit(max_chars))


def search_text(titre: Column, metier: Column, experience: Column, description: Column,
                max_chars: int | None = None) -> Column:
    """Lower-cased model text. Missing parts are empty but keep their separating space."""
    blank = F.lit("")
    parts = [F.coalesce(titre, blank), F.coalesce(metier, blank), F.coalesce(experience, blank),
             bounded(F.coalesce(description, blank), max_chars)]
    spaced = [parts[0]]
    for part in parts[1:]:
        spaced += [F.lit(" "), part]
    return F.lower(F.concat(*spaced))


def split_list(c: Column) -> Column:
    """Comma-separated text to array; NULL and empty text give an empty array."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(c, ","))


def join_list(c: Column) -> Column:
    return F.array_join(c, ",")


# Accented Latin letters and their base letters.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinoooooouuuuyyAAAAAACEEEEIIIINOOOOOOUUUUY"


def fold_accents(c: Column) -> Column:
    """Replace accented Latin letters by their base letter."""
    return F.translate(c, ACCENTED, PLAIN)


def _references() -> Column:
    """Named character references, from the table of the HTML standard in Python's library, as a constant map."""
    named = {name[:-1]: letters for name, letters in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(named)), "map<string,string>")


def unescape_html(c: Column) -> Column:
    """Decode character references that end with a semicolon: all names of the HTML standard and all code points.

    A number that is no character gives the replacement character; an unknown name stays. Each reference is decoded once.
    """
    names = _references()

    def letters(name: Column) -> Column:
        point = F.when(name.rlike("^#[xX]"), F.conv(F.right(F.concat(F.lit("000000000000"), F.substr(name, F.lit(3))), F.lit(12)), 16, 10)
                       ).otherwise(F.substr(name, F.lit(2))).try_cast("bigint")
        valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        letter = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        return F.when(F.startswith(name, F.lit("#")), letter).otherwise(F.try_element_at(names, name))

    def decode(piece: Column) -> Column:
        found = F.regexp_extract(piece, r"^(#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z][a-zA-Z0-9]*);", 1)
        known = once(found, lambda name: F.when(name != "", F.concat(letters(name), F.substr(piece, F.length(name) + 2))))
        return F.coalesce(known, F.concat(F.lit("&"), piece))

    def decoded(text: Column) -> Column:
        whole = once(F.split(text, "&"), lambda pieces: F.concat(F.get(pieces, F.lit(0)), F.array_join(
            F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), decode), "")))
        return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)

    return once(c, decoded)


def absolute_link(base: str, href: Column) -> Column:
    """Site address plus relative link, or empty text without a link."""
    return F.when(F.coalesce(href, F.lit("")) != "", F.concat(F.lit(base), href)).otherwise(F.lit(""))
