"""Fields of stored web pages by pattern. Absent fields are null."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class AttributePattern(str):
    """A pattern whose group is an attribute's value, which holds no tags."""


class Element(NamedTuple):
    """Elements with `name` among their classes, of any tag or of `tag` only."""

    name: str
    tag: str = r"[A-Za-z][\w-]*"


#: a pattern with one group, an element, or containers and what to match inside them
Pattern = str | Element | tuple[str | Element, ...]


def with_class(tag: str, name: str) -> str:
    """Opening tag that has `name` among its classes, in any quoting."""
    return rf"""<{tag}\b[^>]*?\bclass\s*=\s*(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?"|'(?:[^']*\s)?{name}(?:\s[^']*)?'|{name}(?=[\s>]))[^>]*>"""


# an attribute's value, bare: the quotes around it are matched outside the group
_VALUE = r"""["']?((?<=")[^"]*(?=")|(?<=')[^']*(?=')|(?<!["'])[^\s"'>]+)"""


def attribute(tag: str, name: str) -> AttributePattern:
    """Value of an attribute, without the quotes that may stand around it."""
    return AttributePattern(rf"(?i)<{tag}\b[^>]*?\b{name}\s*=\s*{_VALUE}")


LINK = attribute("a", "href")
# Where the fields stand in the markup of a title's detail page:
# a pattern or element, or a container and what to match inside it.
DETAIL_FIELDS = {
    "t_names": Element("title", "span"),
    "t_auth": Element("wrt_nm", "span"),
    "t_genre": (Element("detail_info", "p"), r"(?is)<span\b[^>]*>(.*?)</span\s*>"),
    "t_age": (Element("detail_info", "p"), Element("age", "span")),
    "t_sum": (Element("detail", "div"), r"(?is)</h2\s*>\s*<p\b[^>]*>(.*?)</p\s*>"),
    "t_thumbs": (Element("thumb", "div"), attribute("img", "src")),
}
NEWEST_EPISODE = (Element("title", "td"), LINK)
COMMENT = Element("u_cbox_contents")
LINK_TEXT = rf"(?is)<a\b[^>]*?\bhref\s*=\s*{_VALUE}[^>]*>(.*?)</a\s*>"
LIST_ITEM = r"(?is)<li\b[^>]*>(.*?)</li\s*>"
RATING = r"(?is)<strong\b[^>]*>(.*?)</strong\s*>"

# The entities resolved in text, `&amp;` last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}

_REMARK = r"(?s)<!--.*?-->"
# a page falls into tags and the text between them; a lone `<` is text
_TAG = r"<[/!?A-Za-z][^>]*>"
_PIECE = rf"{_TAG}|[^<]+|<"


def inner_text(fragment: Column) -> Column:
    """Text of a fragment: tags and remarks dropped, common entities resolved."""
    return resolve(F.regexp_replace(fragment, rf"{_REMARK}|{_TAG}", ""))


def resolve(text: Column) -> Column:
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def attr_value(value: Column) -> Column:
    """An attribute's value with its entities resolved; an empty one is absent."""
    return F.nullif(resolve(value), F.lit(""))


def _whole(fragment: Column) -> Column:
    """The element that a fragment begins with, up to the end of its own tag at
    any depth; null if it does not end. The fragment is cut into pieces once, and
    one fold over them counts the tags of that name that are open."""
    tag = F.lower(F.regexp_extract(fragment, r"^<([A-Za-z][\w-]*)", 1))

    def count(state: Column, piece: Column) -> Column:
        same = F.lower(F.regexp_extract(piece, r"^</?([A-Za-z][\w-]*)", 1)) == tag
        depth = state.depth + F.when(~same, 0).when(F.startswith(piece, F.lit("</")), -1).otherwise(1)
        at = state.at + 1
        end = F.when((state.end == 0) & same & (depth == 0), at).otherwise(state.end)
        return F.struct(depth.alias("depth"), at.alias("at"), end.alias("end"))

    def cut(pieces: Column) -> Column:
        none = F.struct(*[F.lit(0).alias(n) for n in ("depth", "at", "end")])
        end = F.aggregate(pieces, none, count, lambda state: state.end)
        return F.transform(F.array(end), lambda n: F.when(n > 0, F.array_join(F.slice(pieces, 1, n), "")))[0]

    return F.transform(F.array(all_matches(fragment, _PIECE, 0)), cut)[0]


def elements(html: Column, wanted: Element) -> Column:
    """array<string>: all elements of a class with what is inside them, in the
    order they begin; tags of their own name may stand inside at any depth, and
    an element inside another of the class is one of its own. One that never
    ends is left out."""
    opening = with_class(wanted.tag, wanted.name)
    parts = F.filter(F.split(F.regexp_replace(html, _REMARK, ""), rf"(?is)(?={opening})"), lambda part, i: (i > 0) | part.rlike(rf"(?is)^{opening}"))

    def one(rest: Column) -> Column:
        # the end is nearly always in the part itself; if not, in what follows
        def of(part: Column, i: Column) -> Column:
            following = F.array_join(F.slice(rest, i + 1, F.size(rest)), "")
            return F.coalesce(_whole(part), F.when(i + 1 < F.size(rest), _whole(following)))

        return F.transform(rest, of)

    return F.array_compact(F.transform(F.array(parts), one)[0])


def first_element(html: Column, wanted: Element) -> Column:
    """The inside of the first element of a class; null without one."""
    opening = with_class(wanted.tag, wanted.name)
    rest = F.regexp_extract(F.regexp_replace(html, _REMARK, ""), rf"(?is){opening}.*$", 0)
    return F.regexp_extract(_whole(rest), rf"(?is)^{opening}(.*)</[^>]*>$", 1)


def first_match(html: Column, pattern: Pattern) -> Column:
    """First group of the first match, or the inside of the first such element;
    of several, each inside what the one before has found."""
    for p in (pattern,) if isinstance(pattern, (str, Element)) else pattern:
        found = first_element(html, p) if isinstance(p, Element) else F.regexp_extract(html, p, 1)
        html = F.nullif(found, F.lit(""))
    return html


def field_text(html: Column, pattern: Pattern) -> Column:
    """`first_match` as text; null if there is none."""
    last = pattern if isinstance(pattern, (str, Element)) else pattern[-1]
    found = first_match(html, pattern)
    return attr_value(found) if isinstance(last, AttributePattern) else inner_text(found)


def links_in(html: Column) -> Column:
    """array<string>: the links of a fragment."""
    return attr_values(html, LINK)


def attr_values(html: Column, pattern: AttributePattern) -> Column:
    """array<string>: the values of an attribute in all its tags, empty ones left out."""
    return F.array_compact(F.transform(all_matches(html, pattern), attr_value))


def first_link(html: Column, within: tuple[str | Element, ...] = ()) -> Column:
    return attr_value(first_match(html, (*within, LINK)))


def all_matches(html: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(html, F.lit(str(pattern)), F.lit(group))


def section(html: Column, pattern: str, position: int) -> Column:
    """The `position`-th (0-based) match, e.g. one weekday's part of a listing."""
    return F.get(all_matches(html, pattern), F.lit(position))
