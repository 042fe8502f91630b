"""Captured pages to entity rows: one parsed row per page, then one select per entity.

All rules are Catalyst expressions over the page text, so the job is a narrow
map: no shuffle, no Python, and a page is read once however many entities it
feeds. Keep the parsed rows (``materialize``) when several entities are wanted.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from indexloom.functions import html as H
from indexloom.functions.text import WHITESPACE, let, non_blank, parse_size, strip_space
from indexloom.registry import ENTITIES

# The texts and markers index pages carry.
CHALLENGE_MARKER = "<title>Client Challenge</title>"
QUARANTINE_TEXT = "This project has been quarantined"
FILE_HOST = "https://files.pythonhosted.org/"
SDIST_HEADINGS = ("Source Distribution", "Source Distributions")
WHEEL_HEADINGS = ("Built Distribution", "Built Distributions")

PROVENANCE_LABELS = {
    "statement_type": "Statement type:",
    "predicate_type": "Predicate type:",
    "subject_name": "Subject name:",
    "subject_digest": "Subject digest:",
    "source_repo": "Permalink:",
    "source_reference": "Branch / Tag:",
    "token_issuer": "Token Issuer:",
    "runner_environment": "Runner Environment:",
    "publisher_workflow": "Publication workflow:",
    "trigger_event": "Trigger Event:",
}

_HISTORY = "array<struct<version:string,is_prerelease:boolean,yanked:boolean,yanked_reason:string>>"


def _page_label(piece: Column) -> Column:
    """Which region of the page a div opens; null for all other divs."""

    def region(tag: Column) -> Column:
        def is_open(*classes: str, **attributes: str) -> Column:
            # Most tags lack the words and need no pattern.
            quick = [tag.contains(c) for c in classes] + [tag.contains(a) for a in attributes]
            return reduce(and_, quick) & H.opens(tag, "div", *classes, **attributes)

        return (
            F.when(~tag.rlike(r"\s(class|id)\s*="), F.lit(None).cast("string"))
            .when(is_open("sidebar-section", "verified"), "verified")
            .when(is_open("sidebar-section", "unverified"), "unverified")
            .when(is_open("package-header__right"), "header")
            .when(is_open("project-description"), "description")
            .when(is_open("release-timeline"), "timeline")
            .when(is_open(id="files[\"']"), "files")
        )

    return let(F.substring_index(piece, ">", 1), region)


# A word that the opening tag of each region holds.
_REGION_WORDS = {
    "verified": "sidebar-section", "unverified": "sidebar-section", "header": "package-header__right",
    "description": "project-description", "timeline": "release-timeline", "files": "files",
}
_VALUE = r"[^\"'>]"
_REGION_CLASSES = "|".join([
    H.has_word("sidebar-section", _VALUE) + f"(?:{H.has_word('verified', _VALUE)}|{H.has_word('unverified', _VALUE)})",
    *[H.has_word(w, _VALUE) for w in ("package-header__right", "project-description", "release-timeline")],
])
# Most tags hold none of the words: one look for any of them comes before the tests one by one.
_ANY_WORD = rf"(?={_VALUE}*?[spr](?:idebar-section|ackage-header__right|roject-description|elease-timeline))"
_PAGE_TESTS = [
    rf"(?=\s)(?=[^>]*?\s[ci](?:lass\s*=\s*[\"']{_ANY_WORD}(?:{_REGION_CLASSES})|d\s*=\s*[\"']files[\"']))"
]


def page_regions(html: Column) -> Column:
    """The page's regions: array of (label, html)."""
    return H.outermost(html, "div", _PAGE_TESTS, _page_label, hidden=True)


def _is_region(element: Column, name: str) -> Column:
    return F.substring_index(element, ">", 1).contains(_REGION_WORDS[name]) & (_page_label(element) == name)


def with_regions(pages: DataFrame, regions_read: bool = True, rest_read: bool = True) -> DataFrame:
    """Add the page regions the rules read, and the page without its hidden parts as ``_page``.

    Without ``regions_read`` the regions are cut out only of pages whose version neither the row nor the page header
    tells, without ``rest_read`` what lies outside them is read only of pages whose row has no version.
    """
    unnamed = F.col("version").isNull()
    split = pages.withColumn("_page", H.without_hidden(F.col("html")))
    doc = F.col("_page") if rest_read else F.when(unnamed, F.col("_page"))
    source = F.col("_page")
    if not regions_read:
        name = H.first_leaf(doc, H.ANY_TAG, "package-header__name")
        source = F.when(unnamed, F.when(current_version(name).isNull(), source))
    # Labels are told for the regions that are read only.
    split = split.withColumn("_regions", H.outermost_html(source, "div", _PAGE_TESTS, _page_label))
    keep = [c for c in pages.columns if c != "html"]
    hits = lambda name: F.filter("_regions", lambda e: _is_region(e, name))
    regions = [
        F.coalesce(F.get(hits(name), 0), F.lit("")).alias(f"_{name}")
        for name in ("verified", "unverified", "description", "timeline", "files")
    ]
    header = F.array_join(hits("header"), "\n").alias("_header")
    name = H.first_leaf(doc, H.ANY_TAG, "package-header__name").alias("_name")
    date = H.first_leaf(doc, H.ANY_TAG, "package-header__date").alias("_date")
    summary = H.first_leaf(doc, H.ANY_TAG, "package-description__summary").alias("_summary")
    tags = F.regexp_extract(doc, rf"(?s){H.opening('ul', 'sidebar-section__classifiers')}.*", 0)
    cut = split.select(*keep, "_page", *regions, header, name, date, summary, tags.alias("_tags"))
    return cut.withColumns(
        {"_own": H.list_items(F.col("_verified")), "_claimed": H.list_items(F.col("_unverified"))}
    )


def quarantine_status(header: Column) -> Column:
    badge = H.opening(H.ANY_TAG, "status-badge")
    hit = header.rlike(rf"(?s){badge}.*?<span(?=[\s>])[^>]*>\s*{QUARANTINE_TEXT}\s*</span")
    return F.when(hit, F.lit("quarantined"))


def owner(verified: Column) -> Column:
    """First link of the list behind the last "Owner" heading: struct(name, display_name), null if none."""
    links = F.filter(H.list_after_heading(verified, "Owner", last=True), lambda a: a["href"] != "")

    def of(link: Column) -> Column:
        slug = F.element_at(F.split(F.regexp_replace(link["href"], "/$", ""), "/"), -1)
        return F.when(link.isNotNull(), F.struct(slug.alias("name"), link["text"].alias("display_name")))

    return let(F.get(links, 0), of)


def current_version(name: Column) -> Column:
    """Last word of the page header; null when the header is empty."""
    return non_blank(F.element_at(F.split(H.clean_text(name), f"[{WHITESPACE}]+"), -1))


def contact(own: Column, claimed: Column, label: str) -> Column:
    """struct(name, email, verified) of an Author or Maintainer line; the verified section wins."""
    def of(line: Column, verified: Column) -> Column:
        mail = F.regexp_replace(H.link_target(line["html"], href="mailto:"), "^mailto:", "")
        return F.struct(
            H.first_line_after(line, label).alias("name"), non_blank(mail).alias("email"), verified.alias("verified")
        )

    return let(
        H.item_with_strong(own, label),
        lambda sure: let(
            F.coalesce(sure, H.item_with_strong(claimed, label)), lambda line: of(line, sure.isNotNull())
        ),
    )


def license_text(claimed: Column) -> Column:
    """The licence expression if its line is there, else the free licence line."""
    plain = H.first_line_after(H.item_with_strong(claimed, "License:"), "License:")
    return let(
        H.item_with_strong(claimed, "License Expression:"),
        lambda spdx: F.when(spdx.isNotNull(), H.first_line_after(spdx, "License Expression:")).otherwise(plain),
    )


def requires_python(claimed: Column) -> Column:
    line = H.item_with_strong(claimed, "Requires:")
    return non_blank(strip_space(F.regexp_replace(H.first_line_after(line, "Requires:"), "^Python", "")))


def keywords(claimed: Column) -> Column:
    tagged = F.filter(claimed, lambda i: H.opens(i["html"], "li", "tags"))
    html = F.array_join(F.transform(tagged, lambda i: i["html"]), "")
    words = F.transform(
        H.all_leaves(html, H.ANY_TAG, "package-keyword"), lambda s: F.btrim(H.clean_text(s), F.lit(" \n\t\r,"))
    )
    return F.filter(words, lambda w: w != "")


def extras(claimed: Column) -> Column:
    line = F.coalesce(H.item_with_strong(claimed, "Provides-Extra:")["html"], F.lit(""))
    return F.transform(H.all_leaves(line, "code"), H.clean_text)


def history(timeline: Column) -> Column:
    """Release history in page order."""
    blocks = H.parts_from(timeline, H.opening("div", "release").removeprefix("<"))
    items = F.filter(blocks, lambda b: H.opens(b, "div", "release"))

    def badge(version: Column, kind: str, text: str) -> Column:
        return version.contains(text) & version.rlike(rf"(?s){H.opening('span', kind)}\s*{text}\s*</span")

    def plain(version: Column) -> Column:
        return F.when(version.contains("<span"), F.regexp_replace(version, r"(?s)<span(?=[\s>]).*?</span\s*>", "")).otherwise(version)

    def entry(item: Column) -> Column:
        reason = non_blank(H.clean_text(H.first_leaf(item, H.ANY_TAG, "release__yanked-reason")))
        return let(
            H.first_leaf(item, H.ANY_TAG, "release__version"),
            lambda cell: let(badge(cell, "badge--danger", "yanked"), lambda yanked: F.struct(
                H.clean_text(plain(cell)).alias("version"),
                badge(cell, "badge--warning", "pre-release").alias("is_prerelease"),
                yanked.alias("yanked"),
                F.when(yanked, reason).alias("yanked_reason"),
            )),
        )

    return F.transform(items, entry).cast(_HISTORY)


def file_kinds(files: Column) -> Column:
    """Listed filenames with the kind of the last known heading above: array of (filename, kind).

    A heading with other words leaves the kind in force unchanged; files above the first
    known heading are left out. A name listed twice keeps its later kind.
    """
    marks = H.parts_from(files, r"h3[\s>]|" + H.opening("div", "file").removeprefix("<"))
    zero = F.struct(
        F.lit("").alias("kind"), F.array().cast("array<struct<filename:string,kind:string>>").alias("found")
    )

    def heading_kind(part: Column) -> Column:
        heading = H.bare_text(F.regexp_extract(part, r"(?s)^<h3[^>]*>(.*?)</h3\s*>", 1))
        return let(
            heading, lambda h: F.when(h.isin(*SDIST_HEADINGS), "sdist").when(h.isin(*WHEEL_HEADINGS), "wheel")
        )

    def listed(part: Column) -> Column:
        name = H.clean_text(H.first_leaf(part, "a", href=FILE_HOST.replace(".", r"\.")))
        return F.when(H.opens(part, "div", "file"), non_blank(name))

    parts = F.transform(
        marks,
        lambda part: F.struct(
            F.when(part.startswith("<h3"), heading_kind(part)).alias("kind"), listed(part).alias("filename")
        ),
    )

    def step(s: Column, part: Column) -> Column:
        row = F.struct(part["filename"].alias("filename"), s["kind"].alias("kind"))
        others = F.filter(s["found"], lambda f: f["filename"] != part["filename"])
        is_file = part["filename"].isNotNull() & (s["kind"] != "")
        return F.struct(
            F.coalesce(part["kind"], s["kind"]).alias("kind"),
            F.when(is_file, F.array_append(others, row)).otherwise(s["found"]).alias("found"),
        )

    return F.aggregate(parts, zero, step, lambda s: s["found"])


def hash_rows(panel: Column) -> Column:
    """Rows of the hash table: array of (algorithm, digest)."""
    body = F.regexp_extract(
        panel, rf"(?s){H.opening('table', 'table--hashes')}.*?<tbody[^>]*>(.*?)</tbody\s*>", 1
    )
    rows = F.regexp_extract_all(body, F.lit(r"(?s)(<tr(?=[\s>]).*?</tr\s*>)"), 1)
    return F.transform(
        rows,
        lambda r: F.struct(
            H.clean_text(H.first_leaf(r, "th", scope="row[\"']")).alias("algorithm"),
            H.clean_text(H.first_leaf(r, "code")).alias("digest"),
        ),
    )


def attestation(panel: Column, items: Column) -> Column:
    """Provenance of one file as a struct; null without a 'Provenance' heading."""
    heading = panel.rlike(f"(?s){H.heading('h3', 'Provenance')}|{H.heading('h4', 'Provenance')}")

    logs = F.filter(items, lambda i: i["text"].startswith("Sigstore transparency entry:"))
    indexes = F.filter(
        F.transform(logs, lambda i: F.regexp_extract(H.attribute(i["html"], "href", "a"), r"logIndex=([+-]?\d+)", 1)),
        lambda n: n != "",
    )
    fields = list(PROVENANCE_LABELS)
    found = F.transform(
        F.array(*[H.first_leaf(H.item_with_prefix(items, PROVENANCE_LABELS[f])["html"], "code") for f in fields]),
        lambda html: non_blank(H.clean_text(html)),
    )
    number = F.try_element_at(indexes, F.lit(-1)).try_cast("bigint")
    row = lambda codes: F.struct(
        F.coalesce(number, F.lit(0).cast("bigint")).alias("sigstore_log_index"),
        H.time_stamp(H.item_with_prefix(items, "Sigstore integration time:")["html"]).alias("integration_time"),
        *[
            (non_blank(F.substring_index(F.get(codes, n), "@", 1)) if f == "source_repo" else F.get(codes, n)).alias(f)
            for n, f in enumerate(fields)
        ],
    )
    return F.when(heading, let(found, row))


# Set before each tag of a panel while panels are cut out that lie within other elements.
_MARK = "\x01"
_DIV_ID = r"(?=\s)(?>[^>]*?\sid\s*=\s*[\"'](?=[^\"'>]))[^\"'>]++[\"'>]"


def file_panels(html: Column, kinds: Column) -> Column:
    """Detail blocks whose id is a listed filename: array of (filename, kind, panel)."""
    return let(H.without_hidden(html), lambda page: _panels(page, kinds))


def _panels(html: Column, kinds: Column) -> Column:
    """``file_panels`` of a page without hidden parts.

    The tags with listed ids are marked, so that one pattern without the names finds the panels.
    """
    def label(piece: Column) -> Column:
        tag = F.substring_index(piece, ">", 1)
        name = F.regexp_extract(tag, r"^<div(?=\s)[^>]*?\sid\s*=\s*[\"']([^\"']+)", 1)
        return let(name, lambda n: F.when((n != "") & F.exists(kinds, lambda k: k["filename"] == n), n))

    def labelled(elements: Column) -> Column:
        return F.transform(elements, lambda e: F.struct(label(e).alias("label"), e.alias("html")))

    def folded() -> Column:
        return let(H.pieces_by(html, "div"), lambda p: F.transform(
            H.element_spans(p, label), lambda s: F.struct(s["label"].alias("label"), H.cut(p, s).alias("html"))
        ))

    def marked(tags: Column) -> Column:
        listed = F.array_distinct(F.filter(tags, lambda t: label(t).isNotNull()))
        return F.aggregate(listed, html, lambda page, t: F.replace(page, t, F.concat(F.lit(_MARK), t)))

    def among_others(tags: Column) -> Column:
        """Panels within elements with other ids."""
        hits = H.marked_html(marked(tags), "div", _MARK)
        plain = lambda h: F.transform(h, lambda e: F.replace(e, F.lit(_MARK), F.lit("")))
        found = let(hits, lambda h: F.when(F.array_contains(h, f"{_MARK}<div"), folded()).otherwise(labelled(plain(h))))
        return F.when(html.contains(_MARK) | F.array_contains(tags, "<div"), folded()).otherwise(found)

    def holds_listed(element: Column) -> Column:
        return F.exists(H.tags_html(H.inner(element), "div", _DIV_ID), lambda t: (t == "<div") | label(t).isNotNull())

    def found(spans: Column) -> Column:
        # Elements with other ids hold no panel on most pages.
        nested = F.exists(spans, lambda s: s["label"].isNull() & ((s["html"] == "<div") | holds_listed(s["html"])))
        tags = H.tags_html(html, "div", _DIV_ID)
        return F.when(nested, let(tags, among_others)).otherwise(F.filter(spans, lambda s: s["label"].isNotNull()))

    none = F.array().cast("array<struct<label:string,html:string>>")
    spans = labelled(H.outermost_with(html, "div", _DIV_ID))
    blocks = F.when(F.size(kinds) == 0, none).otherwise(let(spans, found))
    return F.transform(
        blocks,
        lambda s: F.struct(
            s["label"].alias("filename"),
            F.get(F.filter(kinds, lambda k: k["filename"] == s["label"]), 0)["kind"].alias("kind"),
            s["html"].alias("panel"),
        ),
    )


def file_row(entry: Column, parts: tuple[str, ...] | None = None) -> Column:
    """One detail block as a struct with its hashes, tag and provenance, or of the named parts only."""
    panel, items = entry["panel"], entry["items"]
    trusted = "Uploaded using Trusted Publishing?"
    tag = H.value_after(H.item_with_prefix(items, "Tags:"), "Tags:")
    row = {
        "filename": entry["filename"],
        "path": H.link_target(panel, href=""),
        "size": parse_size(H.decode_references(H.after_label(H.item_with_prefix(items, "Size:"), "Size:"))),
        "upload_time": H.time_stamp(H.item_with_prefix(items, "Upload date:")["html"]),
        "is_trusted_publishing": F.coalesce(
            H.value_after(H.item_with_prefix(items, trusted), trusted) == "Yes", F.lit(False)
        ),
        "uploaded_via": H.value_after(H.item_with_prefix(items, "Uploaded via:"), "Uploaded via:"),
        "packagetype": entry["kind"],
        "hashes": hash_rows(panel),
        "wheel_tag": F.when(entry["kind"] == "wheel", tag),
        "attestation": attestation(panel, items),
    }
    return F.struct(*[row[p].alias(p) for p in parts or row])


def project_links(verified: Column, unverified: Column) -> Column:
    """Links behind 'Project links' in both sections: array of (label, url, verified)."""

    def of(section: Column, flag: bool) -> Column:
        return F.transform(
            H.list_after_heading(section, "Project links"),
            lambda a: F.struct(a["text"].alias("label"), a["href"].alias("url"), F.lit(flag).alias("verified")),
        )

    return F.concat(of(verified, True), of(unverified, False))


def classifiers(tags: Column) -> Column:
    """First classifier list: array of (category, value)."""
    marked = "sidebar-section__classifiers"
    listing = H.first_element(tags, "ul", lambda p: H.opens(p, "ul", marked), H.tag_test("ul", marked))
    groups = H.elements(F.coalesce(H.inner(listing), F.lit("")), "li", lambda p: F.lit(True), "")

    def group(g: Column) -> Column:
        category = H.clean_text(H.first_leaf(g, "strong"))
        nested = F.regexp_extract(g, r"(?s)<ul(?=[\s>])[^>]*>(.*)", 1)
        return F.transform(
            H.links_in_items(nested), lambda a: F.struct(category.alias("category"), a["text"].alias("value"))
        )

    return F.flatten(F.transform(groups, group))


def maintainers(verified: Column) -> Column:
    """Usernames in page order, only under a 'Maintainers' heading."""
    heading = verified.rlike("(?s)" + H.heading("h6", "Maintainers"))
    spans = H.all_leaves(verified, "span", "sidebar-section__user-gravatar-text")
    return F.when(heading, F.transform(spans, H.clean_text)).otherwise(F.array().cast("array<string>"))


def joined_at(html: Column) -> Column:
    """Join date of a profile page: first block with the calendar icon; null if it shows none."""
    blocks = H.elements(H.without_hidden(html), "div", lambda p: H.opens(p, "div", "author-profile__metadiv"))
    dated = F.get(F.filter(blocks, lambda b: b.rlike(H.opening("i", "fa-calendar-alt"))), 0)
    return H.time_stamp(dated)


def first_match(entries: Column, version: Column) -> Column:
    """First history entry of the given version, null if none."""
    return F.get(F.filter(entries, lambda e: e["version"] == version), 0)


FIELDS = {
    "current_version": lambda: F.coalesce(current_version(F.col("_name")), F.get(F.col("_history"), 0)["version"]),
    "history": lambda: F.col("_history"),
    "kinds": lambda: F.col("_kinds"),
    "lifecycle_status": lambda: quarantine_status(F.col("_header")),
    "organization": lambda: owner(F.col("_verified")),
    "created": lambda: H.time_stamp(F.col("_date")),
    "is_prerelease": lambda: F.coalesce(F.col("_entry")["is_prerelease"], F.lit(False)),
    "yanked": lambda: F.coalesce(F.col("_entry")["yanked"], F.lit(False)),
    "yanked_reason": lambda: F.col("_entry")["yanked_reason"],
    "summary": lambda: non_blank(H.clean_text(F.col("_summary"))),
    "license": lambda: license_text(F.col("_claimed")),
    "requires_python": lambda: requires_python(F.col("_claimed")),
    "description": lambda: non_blank(strip_space(H.inner(F.col("_description")))),
    "author": lambda: contact(F.col("_own"), F.col("_claimed"), "Author:"),
    "contact": lambda: contact(F.col("_own"), F.col("_claimed"), "Maintainer:"),
    "keywords": lambda: keywords(F.col("_claimed")),
    "extras": lambda: extras(F.col("_claimed")),
    "files": lambda: F.transform(F.col("_panels"), lambda e: file_row(e)),
    "links": lambda: project_links(F.col("_verified"), F.col("_unverified")),
    "classifiers": lambda: classifiers(F.col("_tags")),
    "maintainers": lambda: maintainers(F.col("_verified")),
}
"""Parsed fields, each a rule over the page regions."""

_OUTSIDE_REGIONS = {"current_version", "created", "summary", "classifiers"}
_OF_HISTORY = {"history", "is_prerelease", "yanked", "yanked_reason"}

ENTITY_FIELDS = {
    "package": ("lifecycle_status", "organization"),
    "organization": ("organization",),
    "release": (
        "created", "is_prerelease", "yanked", "yanked_reason", "summary", "license", "requires_python",
    ),
    "release_detail": ("description", "author", "contact"),
    "release_file": ("files",),
    "file_hash": ("files",),
    "release_file_tag": ("files",),
    "attestation": ("files",),
    "project_link": ("links",),
    "classifier": ("classifiers",),
    "tagged_with": ("classifiers",),
    "release_keyword": ("keywords",),
    "release_extra": ("extras",),
    "maintained_by": ("maintainers",),
}
"""Which parsed fields an entity is made of."""


FILE_PARTS = {
    "release_file": tuple(ENTITIES["release_file"].names[2:]),
    "file_hash": ("filename", "hashes"),
    "release_file_tag": ("filename", "wheel_tag"),
    "attestation": ("filename", "attestation"),
}
"""Which parts of a file row an entity is made of."""


def parse_pages(
    pages: DataFrame, fields: tuple[str, ...] = tuple(FIELDS), file_parts: tuple[str, ...] | None = None
) -> DataFrame:
    """One row per page: ``package, version`` and whatever else came along, plus parsed fields.

    Input needs ``package, version, html``. A null version is taken from the
    page header, else from the first history entry. ``fields`` restricts the
    work to the rules that are needed, ``file_parts`` that of the field files.
    """
    carried = [c for c in pages.columns if c not in ("html", "version")]
    step = with_regions(pages, not set(fields) <= _OUTSIDE_REGIONS, bool(set(fields) & _OUTSIDE_REGIONS)).withColumn("_kinds", file_kinds(F.col("_files")))
    if set(fields) & _OF_HISTORY:
        step = step.withColumn("_history", history(F.col("_timeline")))
    else:
        # Read only where neither the row nor the header names a version.
        needed = F.when(F.col("version").isNull(), F.when(current_version(F.col("_name")).isNull(), F.col("_timeline")))
        step = step.withColumn("_history", F.when(needed.isNotNull(), history(needed)))
    step = step.withColumn("_version", F.coalesce(F.col("version"), FIELDS["current_version"]()))
    step = step.withColumn("_entry", first_match(F.col("_history"), F.col("_version")))
    if "files" in fields:
        panels = F.transform(
            _panels(F.col("_page"), F.col("_kinds")),
            lambda f: F.struct(f["filename"], f["kind"], f["panel"], H.list_items(f["panel"]).alias("items")),
        )
        step = step.withColumn("_panels", panels)
    columns = {f: FIELDS[f]() for f in fields}
    if file_parts and "files" in fields:
        columns["files"] = F.transform(F.col("_panels"), lambda e: file_row(e, file_parts))
    return evaluated_once(step, carried, {"version": F.col("_version"), **columns})


def evaluated_once(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """``keep`` plus computed columns, through a generator over a single struct.

    Filters and further projections are not moved below a generator. Without it
    a filter on a parsed field is pushed through every projection down to the
    scan, where the page rules are repeated for each mention of their inputs.
    """
    row = F.struct(*[v.alias(k) for k, v in columns.items()])
    return df.select(*keep, F.inline_outer(F.array(row)))


def _inlined(parsed: DataFrame, order: list[str], rows: Column) -> DataFrame:
    """One output row per struct of the array, its fields as columns.

    The array holds exactly the fields that are wanted. Picking fields after an
    explode would make the optimizer evaluate the page rules once per field.
    """
    head = [*order, F.col("package").alias("package_name"), "version"]
    return parsed.select(*head, rows.alias("_rows")).select(*order, "package_name", "version", F.inline("_rows"))


def _positioned(array: str, **fields) -> Column:
    """Array of structs with ``pos`` and the named fields of each element."""
    return F.transform(
        array, lambda e, n: F.struct(n.alias("pos"), *[(f(e) if callable(f) else e[f]).alias(k) for k, f in fields.items()])
    )


def _per_file(make) -> Column:
    """Array over all files of what ``make(file)`` gives as an array."""
    return F.flatten(F.transform("files", make))


def entity_rows(parsed: DataFrame, entity: str, order: list[str] | None = None) -> DataFrame:
    """Rows of one entity from parsed pages, not yet deduplicated.

    ``order`` names carried columns (page order) to keep in front; list
    entities then also keep ``pos``, the place within the page.
    """
    order = order or []
    names = ENTITIES[entity].names
    name = F.col("package").alias("package_name")
    pos = ["pos"] if order else []
    if entity == "package":
        return parsed.select(
            *order, F.col("package").alias("name"), "lifecycle_status", F.col("organization.name").alias("organization_owner")
        )
    if entity == "organization":
        return parsed.where("organization is not null").select(*order, "organization.name", "organization.display_name")
    if entity == "release":
        return parsed.select(
            *order,
            name,
            *[F.lit(None).cast("string").alias(c) if c == "lifecycle_status" else F.col(c) for c in names[1:]],
        )
    if entity == "release_detail":
        return parsed.select(
            *order,
            name,
            "version",
            "description",
            F.col("author.name").alias("meta_author"),
            F.col("author.email").alias("meta_author_email"),
            F.col("author.verified").alias("meta_author_email_verified"),
            F.col("contact.name").alias("meta_maintainer"),
            F.col("contact.email").alias("meta_maintainer_email"),
            F.col("contact.verified").alias("meta_maintainer_email_verified"),
        )
    if entity == "release_file":
        rows = _inlined(parsed, order, _positioned("files", **{c: c for c in names[2:]}))
        return rows.select(*order, *pos, *names)
    if entity == "file_hash":
        hashes = _per_file(
            lambda f: F.transform(
                f["hashes"], lambda h: F.struct(f["filename"].alias("filename"), h["algorithm"], h["digest"])
            )
        )
        return _inlined(parsed, order, hashes).toDF(*order, *names)
    if entity == "release_file_tag":
        tagged = F.filter("files", lambda f: f["wheel_tag"].isNotNull())
        return _inlined(parsed, order, F.transform(tagged, lambda f: F.struct(f["filename"], f["wheel_tag"]))).toDF(
            *order, *names
        )
    if entity == "attestation":
        proven = F.filter("files", lambda f: f["attestation"].isNotNull())
        rows = F.transform(
            proven, lambda f: F.struct(f["filename"], *[f["attestation"][c].alias(c) for c in names[3:]])
        )
        return _inlined(parsed, order, rows).toDF(*order, *names)
    if entity == "project_link":
        rows = _inlined(parsed, order, _positioned("links", label="label", url="url", verified="verified"))
        return rows.select(*order, *pos, *names)
    if entity in ("classifier", "tagged_with"):
        rows = _inlined(parsed, order, _positioned("classifiers", category="category", value="value"))
        return rows.select(*order, *pos, *names)
    lists = {
        "release_keyword": ("keywords", "keyword"),
        "release_extra": ("extras", "extra_name"),
        "maintained_by": ("maintainers", "maintainer_username"),
    }
    if entity in lists:
        array, column = lists[entity]
        return _inlined(parsed, order, _positioned(array, **{column: lambda e: e})).select(*order, *pos, *names)
    raise ValueError(f"{entity} does not come from package pages")
