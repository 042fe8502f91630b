"""Reading HTML fragments with Catalyst expressions.

A page stays one string in one row. Elements are cut out by a pattern that
follows nested tags of one kind, or by splitting at these tags and following
the depth over the pieces with a fold, so nothing is exploded, shuffled or sent to Python. Leaf elements that cannot
contain themselves (a, code, time, h3 ...) are matched by pattern.
"""

from __future__ import annotations

import html.entities
import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from indexloom.functions.text import let, non_blank, strip_space

# All named character references with their closing semicolon, as one text in which a name
# is found without a map literal of thousands of entries: start mark, name, end mark, characters.
_START, _END = "\x02", "\x03"
_NAMED = _START + _START.join(
    f"{name[:-1]}{_END}{value}" for name, value in html.entities.html5.items() if name.endswith(";") and name != "amp;"
) + _START

ANY_TAG = r"[A-Za-z][A-Za-z0-9]*"


_REFERENCE = r"&(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"
_RARE = r"&(?!amp;)(?:#|[A-Za-z])[A-Za-z0-9]*;"
_FREQUENT = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#34;": '"', "&#39;": "'", "&nbsp;": "\xa0"}
_AMPERSAND = r"&(?:amp|AMP|#0*38|#[xX]0*26);"


def has_word(word: str, within: str = r"[^\"']") -> str:
    """Pattern of a place in an attribute from which the word follows; what stands before it is read where it is found only."""
    return rf"(?={within}*?{re.escape(word)}(?<![\w-][^>]{{{len(word)}}})(?![\w-]))"


def opening(tag: str = ANY_TAG, *classes: str, **attributes: str) -> str:
    """Pattern of an opening tag that carries all the classes and attribute patterns."""
    looks = ""
    if classes:
        words = "".join(has_word(c) for c in classes)
        looks += rf"(?=[^>]*?\sclass\s*=\s*[\"']{words})"
    for name, pattern in attributes.items():
        looks += rf"(?=[^>]*?\s{name}\s*=\s*[\"']{pattern})"
    return rf"<{tag}(?=[\s>/]){looks}[^>]*>"


def opens(piece: Column, tag: str, *classes: str, **attributes: str) -> Column:
    """Whether a piece starts with such an opening tag; only the tag itself is searched."""
    pattern = opening(tag, *classes, **attributes)
    return F.substring_index(piece, ">", 1).rlike("^" + pattern.removesuffix("[^>]*>"))


_HIDDEN = r"(?:!--.*?-->|(?i:script(?=[\s>]).*?</script\s*>|style(?=[\s>]).*?</style\s*>))"


# A page that hides scripts in lower case only: no other tag may begin as a hidden part does.
_SCRIPTS_ONLY = r"\A(?>[^<]*)(?:<(?=[^!Ss]|!(?!--)|script|s(?!(?i:cript|tyle))|\z)(?>[^<]*))*+\z"


def without_hidden(html: Column) -> Column:
    """Drop comments, scripts and styles, whose content is not markup."""
    # A pattern that starts with the literal tag is searched several times faster; it fits pages that hide scripts only.
    scripts = F.regexp_replace(html, r"(?s)<script(?=[\s>]).*?(?i:</script\s*>)", "")
    # The second character is looked at first: most tags fail there.
    every = F.regexp_replace(html, rf"(?s)<(?=[!sS]){_HIDDEN}", "")
    return F.when(html.rlike(_SCRIPTS_ONLY), scripts).otherwise(every)


def decode_references(text: Column) -> Column:
    """Named and numeric character references; the ampersand itself goes last."""

    def put(acc: Column, ref: Column) -> Column:
        # Leading zeros are legal; more than eight digits are beyond any character.
        digits = F.substring(F.regexp_replace(ref, "^#[xX]?0*", ""), 1, 9)
        code = F.when(ref.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
        code = code.try_cast("bigint")
        legal = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(legal, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        whole = F.concat(F.lit("&"), ref, F.lit(";"))
        entry = F.concat(F.lit(_START), ref, F.lit(_END))
        value = F.substring_index(F.call_function("substring_index", F.lit(_NAMED), entry, F.lit(-1)), _START, 1)
        named = F.when(F.instr(F.lit(_NAMED), entry) > 0, value).otherwise(whole)
        return F.replace(acc, whole, F.when(ref.startswith("#"), char).otherwise(named))

    def named_or_numbered(raw: Column) -> Column:
        refs = F.array_distinct(F.regexp_extract_all(F.regexp_replace(raw, _AMPERSAND, ""), F.lit(_REFERENCE), 1))
        return F.aggregate(refs, raw, put)

    def decode(raw: Column) -> Column:
        frequent = raw
        for ref, char in _FREQUENT.items():
            frequent = F.replace(frequent, F.lit(ref), F.lit(char))
        # What these give can't begin or end a reference; few texts hold any other.
        rest = let(frequent, lambda t: F.when(t.rlike(_RARE), named_or_numbered(t)).otherwise(t))
        return F.when(raw.contains("&"), F.regexp_replace(rest, _AMPERSAND, "&")).otherwise(raw)

    return let(text, decode)


def _without_tags(fragment: Column) -> Column:
    return let(fragment, lambda f: F.when(f.contains("<"), F.regexp_replace(f, r"<[^>]*>", "")).otherwise(f))


def bare_text(fragment: Column) -> Column:
    """Trimmed text with references left as they are; enough to compare with fixed labels."""
    return strip_space(_without_tags(fragment))


def clean_text(fragment: Column) -> Column:
    """Trimmed text content."""
    return strip_space(decode_references(_without_tags(fragment)))


def first_leaf(fragment: Column, tag: str, *classes: str, **attributes: str) -> Column:
    """Inner HTML of the first such element, for elements that never contain their own tag; '' if none."""
    if tag == ANY_TAG:
        pattern = opening(f"({tag})", *classes, **attributes)
        return F.regexp_extract(fragment, rf"(?s){pattern}(.*?)</\1\s*>", 2)
    return F.regexp_extract(fragment, rf"(?s){opening(tag, *classes, **attributes)}(.*?)</{tag}\s*>", 1)


def all_leaves(fragment: Column, tag: str, *classes: str, **attributes: str) -> Column:
    """Outer HTML of every such element, for elements that never contain their own tag."""
    pattern = opening(tag, *classes, **attributes)
    if tag == ANY_TAG:
        pattern, tag = pattern.replace(ANY_TAG, f"({ANY_TAG})", 1), r"\2"
    return F.regexp_extract_all(fragment, F.lit(rf"(?s)({pattern}.*?</{tag}\s*>)"), 1)


def attribute(fragment: Column, name: str, tag: str, **attributes: str) -> Column:
    """Raw attribute of the first matching tag, quotes of either kind; '' if there is none."""
    found = F.regexp_extract(fragment, opening(tag, **attributes).replace("[^>]*>", r"[^>]*?>"), 0)
    return F.regexp_replace(
        F.regexp_extract(found, rf"\s{name}\s*=\s*(\"[^\"]*|'[^']*)", 1), r"^[\"']", ""
    )


def link_target(fragment: Column, **attributes: str) -> Column:
    """Decoded href of the first link."""
    return decode_references(attribute(fragment, "href", "a", **attributes))


def time_stamp(fragment: Column) -> Column:
    """The machine-readable datetime of the first time element; null if none."""
    return non_blank(attribute(fragment, "datetime", "time"))


def element_spans(pieces: Column, label_of: Callable[[Column], Column]) -> Column:
    """Outermost elements over ``pieces`` (text split before each tag of one kind).

    ``label_of`` maps a piece to a label, null where the piece opens nothing of
    interest. Result: array of (label, first, size) in page order, ``first``
    counting from 1. An element left open runs to the end of the page.
    """
    zero = F.expr(
        "named_struct('at', 0, 'depth', 0, 'start', 0, 'base', 0, 'label', cast(null as string),"
        " 'found', cast(array() as array<struct<label:string,first:int,size:int>>))"
    )

    def step(s: Column, piece: Column) -> Column:
        closes = piece.startswith("</")
        opens = piece.startswith("<") & ~closes
        depth = s["depth"] + F.when(closes, -1).when(opens, 1).otherwise(0)
        at = s["at"] + 1
        label = F.when((s["start"] == 0) & opens, label_of(piece))
        ends = (s["start"] > 0) & closes & (depth <= s["base"])
        span = F.struct(s["label"].alias("label"), s["start"].alias("first"), (at - s["start"]).alias("size"))
        marked = F.struct(
            at.alias("at"), depth.alias("depth"), at.alias("start"), s["depth"].alias("base"),
            label.alias("label"), s["found"].alias("found"),
        )
        ended = F.struct(
            at.alias("at"), depth.alias("depth"), F.lit(0).alias("start"), s["base"].alias("base"),
            F.lit(None).cast("string").alias("label"), F.array_append(s["found"], span).alias("found"),
        )
        passed = F.struct(
            at.alias("at"), depth.alias("depth"), s["start"].alias("start"), s["base"].alias("base"),
            s["label"].alias("label"), s["found"].alias("found"),
        )
        return F.when(ends, ended).when(label.isNotNull(), marked).otherwise(passed)

    def finish(s: Column) -> Column:
        rest = F.struct(s["label"].alias("label"), s["start"].alias("first"), (s["at"] - s["start"] + 1).alias("size"))
        return F.when(s["start"] > 0, F.array_append(s["found"], rest)).otherwise(s["found"])

    return F.aggregate(pieces, zero, step, finish)


def parts_from(fragment: Column, start: str) -> Column:
    """What ``split`` before each ``<`` followed by the pattern ``start`` gives, but a first part that begins with no tag.

    A pattern to split by would be built again for each row.
    """
    return F.regexp_extract_all(
        fragment, F.lit(rf"(?s)(?:\A<|<(?={start}))(?>[^<]*)(?:<(?!{start})(?>[^<]*))*+"), F.lit(0)
    )


def pieces_by(fragment: Column, tag: str) -> Column:
    """The fragment split before every opening and closing ``tag``."""
    return F.split(fragment, rf"(?=</?{tag}[\s>])")


def cut(pieces: Column, span: Column) -> Column:
    """HTML of one span, opening tag included, closing tag and what follows left out."""
    return F.array_join(F.slice(pieces, span["first"], span["size"]), "")


#: Levels of nested tags that a pattern follows; elements nested deeper are folded.
NESTING = 8


# Behind ``<tag``: a tag without end, or another that only a fold over the pieces reads.
_ODD = r"(?=/)|(?=\s[^<>]*+(?:<|\z))"


def _closed(tag: str) -> str:
    """Pattern of text in which each ``tag`` is closed, up to the levels followed; it never backtracks."""
    text = rf"(?>[^<]*)(?:<(?!/{tag}[\s>]|{tag}[\s>])(?>[^<]*))*+"
    inside = text
    for _ in range(NESTING):
        inside = rf"{text}(?:<{tag}(?=[\s>]){inside}</{tag}(?=[\s>]){text})*+"
    return inside


def tag_test(tag: str, *classes: str, **attributes: str) -> str:
    """The tests of ``opening`` alone, for a tag that is known to hold no other before its end."""
    looks = opening(tag, *classes, **attributes).removeprefix(rf"<{tag}(?=[\s>/])").removesuffix("[^>]*>")
    return looks.replace(r"""[^\"']*""", r"""[^\"'>]*""")


def outermost_html(html: Column, tag: str, tests: list[str], label_of: Callable[[Column], Column]) -> Column:
    """Outermost elements in page order, their closing tags left out, of html without comments, scripts and styles.

    ``tests`` are patterns that hold behind ``<tag`` of exactly those tags that ``label_of`` labels.
    One pattern finds all such elements. A page with an
    element left open, nested deeper than ``NESTING`` or in a tag without end is folded over its pieces.
    """
    body = rf"{tag}(?:{_ODD}|(?=[\s>])(?:{'|'.join(tests)})(?:{_closed(tag)}(?=</{tag}[\s>]))?+)"

    def found(text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(rf"(?s)<{body}"), F.lit(0))

    def folded(text: Column) -> Column:
        return let(pieces_by(text, tag), lambda p: F.transform(element_spans(p, label_of), lambda s: cut(p, s)))

    return let(
        html, lambda text: let(found(text), lambda hits: F.when(F.array_contains(hits, f"<{tag}"), folded(text)).otherwise(hits))
    )


def outermost(html: Column, tag: str, tests: list[str], label_of: Callable[[Column], Column], hidden: bool = False) -> Column:
    """``outermost_html`` with the labels: array of (label, html).

    With ``hidden`` the html still has its comments, scripts and styles, which are dropped first.
    """
    found = outermost_html(without_hidden(html) if hidden else html, tag, tests, label_of)
    return F.transform(found, lambda e: F.struct(label_of(e).alias("label"), e.alias("html")))


def tags_html(html: Column, tag: str, test: str) -> Column:
    """What ``<tag`` and the pattern ``test`` match, in page order; a bare ``<tag`` for one that only a fold can read."""
    return F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}(?:{_ODD}|{test})"), F.lit(0))


def outermost_with(html: Column, tag: str, test: str) -> Column:
    """``outermost_html`` of the tags behind which ``test`` matches; a bare ``<tag`` where only a fold can read them."""
    found = rf"{test}{_closed(tag)}(?=</{tag}[\s>])"
    return F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}(?:{_ODD}|{found}|(?={test}))"), F.lit(0))


def marked_html(html: Column, tag: str, mark: str) -> Column:
    """``outermost_html`` of the tags with a mark before them; the mark and ``<tag`` alone where only a fold can read it."""
    return F.regexp_extract_all(html, F.lit(rf"(?s){mark}<{tag}(?:{_closed(tag)}(?=</{tag}[\s>]))?+"), F.lit(0))


def first_element(fragment: Column, tag: str, wanted: Callable[[Column], Column], test: str) -> Column:
    """The first of ``elements``; null if none. Where the fragment starts with it nothing behind it is read."""
    here = F.regexp_extract(fragment, rf"(?s)^<{tag}(?=[\s>])(?=[^<>]*+>){_closed(tag)}(?=</{tag}[\s>])", 0)
    return let(here, lambda e: F.when((e != "") & wanted(e), e).otherwise(F.get(elements(fragment, tag, wanted, test), 0)))


def inner(outer: Column) -> Column:
    """What follows the first tag of a cut span."""
    return F.regexp_replace(outer, r"^<[^>]*>", "")


def elements(fragment: Column, tag: str, wanted: Callable[[Column], Column], test: str | None = None) -> Column:
    """HTML of the outermost elements whose opening piece satisfies ``wanted``, in page order.

    With ``test`` (``tag_test``, '' for every tag) that says the same they are found by pattern.
    """
    mark = lambda p: F.when(wanted(p), F.lit("x"))
    fold = lambda f: let(pieces_by(f, tag), lambda p: F.transform(element_spans(p, mark), lambda s: cut(p, s)))
    if test is None:
        return fold(fragment)
    # A piece before the first tag that starts with another one may be wanted as well.
    other = lambda f: f.rlike(rf"^<(?!{tag}[\s>])")
    found = lambda f: F.transform(outermost(f, tag, [test], mark), lambda e: e["html"])
    return let(fragment, lambda f: F.when(other(f), fold(f)).otherwise(found(f)))


def labelled(regions: Column, label: str) -> Column:
    """HTML of all regions with one label, in page order."""
    return F.transform(F.filter(regions, lambda r: r["label"] == label), lambda r: r["html"])


def first_labelled(regions: Column, label: str) -> Column:
    """First region with the label; '' if none. Hidden second copies are never read."""
    return F.coalesce(F.get(F.filter(regions, lambda r: r["label"] == label), 0)["html"], F.lit(""))


def list_items(fragment: Column) -> Column:
    """Each li up to its own end or the next li, in page order: array of (html, text, strong).

    ``text`` is the trimmed text, ``strong`` that of the first bold element.
    """
    item = r"(?s)(?:\A<li|<li(?=[\s>]))(?>[^<]*)(?:<(?!/li|li[\s>])(?>[^<]*))*+"
    return F.transform(
        F.regexp_extract_all(fragment, F.lit(item), F.lit(0)),
        lambda i: F.struct(
            i.alias("html"), bare_text(i).alias("text"), bare_text(first_leaf(i, "strong")).alias("strong")
        ),
    )


def item_with_strong(items: Column, label: str) -> Column:
    """First item whose bold text equals the label; null if none."""
    return F.get(F.filter(items, lambda i: i["strong"] == label), 0)


def item_with_prefix(items: Column, prefix: str) -> Column:
    """First item whose text starts with the prefix; null if none."""
    return F.get(F.filter(items, lambda i: i["text"].startswith(prefix)), 0)


def after_label(item: Column, label: str) -> Column:
    """Raw text of an item behind its label."""
    return F.regexp_replace(item["text"], "^" + re.escape(label), "")


def value_after(item: Column, label: str) -> Column:
    """Trimmed text of an item behind its label; null if empty or no item."""
    return non_blank(strip_space(decode_references(after_label(item, label))))


def first_line_after(item: Column, label: str) -> Column:
    """Like ``value_after`` but only up to the first line break behind the label."""
    return non_blank(strip_space(decode_references(F.substring_index(after_label(item, label), "\n", 1))))


def heading(tag: str, text: str) -> str:
    """Pattern of a heading whose trimmed text is ``text``, whatever icons or other markup it holds."""
    pad = rf"(?:\s|&nbsp;|<(?!/?{tag}[\s>])[^>]*>)*+"
    return rf"<{tag}(?=[\s>])[^>]*>{pad}{text}{pad}</{tag}\s*>"


def list_after_heading(fragment: Column, text: str, last: bool = False) -> Column:
    """Links of the lists right behind each h6 with the given text, or behind the last: array of (href, text)."""
    pattern = rf"(?s){heading('h6', text)}\s*{opening('ul', 'vertical-tabs__list')}(.*?)</ul\s*>"
    lists = F.regexp_extract_all(fragment, F.lit(pattern), 1)
    return links_in_items(F.coalesce(F.try_element_at(lists, F.lit(-1)), F.lit("")) if last else F.array_join(lists, ""))


def links_in_items(fragment: Column) -> Column:
    """Every link inside a li: array of (href, text)."""
    listed = F.regexp_extract(fragment, r"(?s)<li[\s>].*", 0)
    return F.transform(
        all_leaves(listed, "a"), lambda a: F.struct(link_target(a).alias("href"), clean_text(a).alias("text"))
    )
