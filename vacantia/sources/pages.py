"""Posting cards from job pages, by expressions over a table of pages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.functions.text import absolute_link, once, strip, unescape_html
from vacantia.schema import SCRAPED_MISSING, SCRAPED_SITE

# Markup of the job site. Labels are tried in this order; the last item of a card that
# carries a label gives the value.
SITE_BASE = "https://www.emploi.ma"
SITE_COUNTRY = "Maroc"
ITEM_LABELS = {
    "niveau_etudes": "études",
    "experience": "expérience",
    "type_contrat": "Contrat",
    "region": "Région",
    "competences": "Compétences",
}


@dataclass(frozen=True)
class CardLayout:
    """Where cards and their parts are on a page."""

    tag: str = "div"
    css_class: str | None = "card-job-detail"
    title_tag: str = "h3"
    company_class: str = "card-job-company"
    base: str = SITE_BASE
    labels: dict[str, str] = field(default_factory=lambda: dict(ITEM_LABELS))


def plain_text(html: Column) -> Column:
    """Text of a fragment: tags removed, references decoded, stripped."""
    without = once(html, lambda text: F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, r"(?s)<[^>]*>", "")).otherwise(text))
    return strip(unescape_html(without))


def _first(html: Column, pattern: str, group: int = 1) -> Column:
    """First match or NULL."""
    found = F.regexp_extract(html, pattern, group)
    return once(found, lambda text: F.when((text != "") | html.rlike(pattern), text))


def element(tag: str) -> str:
    return rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"


def _cut_at_end(piece: Column, tag: str) -> Column:
    """A piece of page that starts inside an element, up to the end of that element.

    Nested elements of the same tag are counted. Without a closing tag the whole piece is kept.
    """

    def step(state: Column, part: Column) -> Column:
        head = F.lower(F.left(part, F.lit(len(tag) + 2)))
        change = F.when(F.startswith(head, F.lit(f"</{tag}")), -1).when(F.startswith(head, F.lit(f"<{tag}")), 1).otherwise(0)
        depth = state["depth"] + change
        ended = (state["end"] < 0) & (depth <= 0)
        return F.struct(depth.alias("depth"), (state["at"] + 1).alias("at"),
                        F.when(ended, state["at"]).otherwise(state["end"]).alias("end"))

    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("end"))

    def cut(parts: Column) -> Column:
        return once(F.aggregate(parts, start, step)["end"], lambda end: F.when(
            end >= 0, F.array_join(F.slice(parts, F.lit(1), F.greatest(end, F.lit(0))), "")))

    return F.coalesce(once(F.split(piece, rf"(?i)(?=<{tag}\b)|(?=</{tag}\b)"), cut), piece)


def card_fragments(pages: DataFrame, layout: CardLayout, html: str = "html") -> DataFrame:
    """One row per card: page columns, ``position`` and ``card`` (the inside of the element)."""
    attribute = "" if layout.css_class is None else \
        rf"""(?=[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{layout.css_class}(?:\s[^"']*)?["'])"""
    opening = rf"(?i)<{layout.tag}\b{attribute}[^>]*>"
    others = [c for c in pages.columns if c != html]
    inside = once(F.split(html, opening, -1), lambda pieces: F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))))
    return (
        pages.select(*others, F.posexplode(inside).alias("position", "_piece"))
        .select(*others, "position", _cut_at_end(F.col("_piece"), layout.tag).alias("card"))
    )


def extract_cards(pages: DataFrame, layout: CardLayout = CardLayout(), html: str = "html") -> DataFrame:
    """Postings as the site shows them. A missing part reads ``Non precise``; a card without link has none."""
    cards = card_fragments(pages, layout, html)
    others = [c for c in cards.columns if c != "card"]
    card, missing = F.col("card"), F.lit(SCRAPED_MISSING)

    def label_of(text: Column) -> Column:
        label = F.lit(None).cast("string")
        for name, word in reversed(layout.labels.items()):
            label = F.when(F.contains(text, F.lit(word)), F.lit(name)).otherwise(label)
        return label

    title = _first(card, element(layout.title_tag))
    company = _first(card, rf"""(?is)<a\b(?=[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{layout.company_class}(?:\s[^"']*)?["'])[^>]*>(.*?)</a\s*>""")
    # Each step names what the one before has computed, so nothing is computed for every use of it.
    items = F.transform(F.regexp_extract_all(card, F.lit(element("li")), F.lit(1)),
                        lambda li: F.struct(once(plain_text(li), label_of).alias("label"), li.alias("li")))
    parts = cards.select(*others, title.alias("_title"), company.alias("_company"), items.alias("_items"),
                         _first(card, element("time")).alias("_time"))

    def last(name: str) -> Column:
        return F.try_element_at(F.filter("_items", lambda item: F.coalesce(item["label"] == name, F.lit(False))), F.lit(-1))["li"]

    href = _first(F.col("_title"), r"""(?is)<a\b[^>]*\bhref\s*=\s*["']([^"']*)["']""")
    found = parts.select(*others, "_title", "_company", "_time", href.alias("_href"), *[last(n).alias(f"_{n}") for n in layout.labels])

    def labelled(name: str) -> Column:
        value = plain_text(_first(F.col(f"_{name}"), element("strong")))
        return F.when(F.col(f"_{name}").isNotNull(), F.coalesce(value, F.lit(""))).otherwise(missing).alias(name)

    return found.select(
        *others,
        F.coalesce(plain_text(F.col("_title")), missing).alias("titre"),
        F.coalesce(plain_text(F.col("_company")), missing).alias("entreprise"),
        *[labelled(name) for name in layout.labels],
        F.coalesce(plain_text(F.col("_time")), missing).alias("date_publication"),
        once(unescape_html(F.col("_href")), lambda link: absolute_link(layout.base, link)).alias("url_offre"),
        F.lit(SCRAPED_SITE).alias("source"), F.lit(SITE_COUNTRY).alias("pays"),
    ).withColumn("ville", F.col("region") if "region" in layout.labels else missing)
