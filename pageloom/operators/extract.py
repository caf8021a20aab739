"""Page rows to article parts: title, content root, links, media, callouts, sections, concepts.

Input is ``parse_pages`` output. Each step adds a column computed from the row's node array with
higher-order SQL functions, so a plan is scan -> Arrow parse -> projections, with no exchange at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.sql import bind, each, either, first, group, keep, last, matches, q, some, strip, struct, sub, title_case
from pageloom.functions.text import char_count, word_count
from pageloom.functions.urls import host, resolve_url
from pageloom.operators import rules
from pageloom.operators.dom import (
    TEXT, attr, class_like, has_class, having, joined_text, mark, overlay, parse_pages, subtree,
)
from pageloom.operators.markdown import inline_markdown, page_markdown
from pageloom.operators.rules import Site

HEADINGS = ("h2", "h3", "h4")


def columns(df: DataFrame, **named: str) -> DataFrame:
    return df.select("*", *[F.expr(text).alias(name) for name, text in named.items()])


def first_per_key(items: str, key: str) -> str:
    """Items whose key was not seen earlier in the array."""
    return bind(
        items,
        lambda xs: bind(
            each(xs, lambda x: f"{x}.{key}"),
            lambda ks: keep(xs, lambda x, i: f"array_position({ks}, {x}.{key}) = {i} + 1", 2),
        ),
    )


# ---- title and root ------------------------------------------------------------------------------


def title(site: Site) -> str:
    def without_suffix(text):
        for suffix in site.title_suffixes:
            text = sub(text, r"\Q" + suffix + r"\E\z")
        return text

    h1, tag = first(having("nodes", "h1")), first(having("nodes", "title"))
    return (
        f"coalesce({joined_text('nodes', h1)}, {without_suffix(joined_text('nodes', tag))}, 'Untitled')"
    )


def content_root() -> str:
    """Second inner cell, else second cell, else the first hit of the fallback list, else the body.
    ``theme`` tells whether the inner-cell rule fired; only then is the last section tested."""
    inner = keep("nodes", lambda n: has_class(n, "flex_cell_inner"))
    cells = keep("nodes", lambda n: has_class(n, "flex_cell"))

    def hit(kind, name):
        if kind == "tag":
            return first(having("nodes", name))
        if kind == "class":
            return first(keep("nodes", lambda n: has_class(n, name)))
        return first(keep("nodes", lambda n: f"{attr(n, 'id')} = {q(name)}"))

    fallbacks = [hit(kind, name) for kind, name in rules.FALLBACK_TAGS_AND_CLASSES] + [hit("tag", "body")]
    node = f"coalesce(try_element_at({inner}, 2), try_element_at({cells}, 2), {', '.join(fallbacks)})"
    return struct(node=node, theme=f"size({inner}) >= 2")


def is_call_to_action(section: str, site: Site) -> str:
    below = subtree("nodes", section)

    def promo_link(a):
        href = f"coalesce({attr(a, 'href')}, '')"
        return f"not contains({href}, '/blog/') and {matches(href, rules.PROMO_HREF)}"

    def promo_heading(h):
        return bind(
            f"lower({joined_text('nodes', h)})",
            lambda words: " or ".join(f"contains({words}, {q(p)})" for p in rules.PROMO_HEADINGS),
        )

    return bind(
        joined_text("nodes", section),
        lambda text: f"case when contains(upper({text}), 'RELATED ARTICLE') then false "
        f"when {some(below, lambda n: class_like(n, rules.BUTTON_CLASS))} then true "
        f"when {some(having(below, 'a'), promo_link)} then true "
        f"when {matches(text, site.promo_text)} then true "
        f"else {some(having(below, *HEADINGS), promo_heading)} end",
    )


def is_removed(n: str) -> str:
    tags = ", ".join(q(t) for t in rules.NON_CONTENT_TAGS)
    return (
        f"({n}.tag in ({tags}) or coalesce({matches(attr(n, 'style'), rules.HIDDEN_STYLE)}, false) "
        f"or {class_like(n, rules.PROMO_CLASS)} or ({n}.tag = 'a' "
        f"and coalesce({matches(attr(n, 'href'), rules.PROMO_HREF)}, false) "
        f"and {class_like(n, '(?i)button|cta')}))"
    )


def with_content(parsed: DataFrame, site: Site, whole_body: bool = False) -> DataFrame:
    """Adds ``title``, ``root``, ``visible`` (the node array with removed subtrees blanked), ``body``
    (descendants of the root) and ``headings``. ``whole_body`` takes the body as the root."""
    body_root = struct(node=first(having("nodes", "body")), theme="false")
    parsed = parsed.filter("exists(nodes, n -> n.tag = 'body')")
    df = columns(parsed, title=title(site), _root=body_root if whole_body else content_root())
    df = df.withColumn("root", F.col("_root.node"))
    closing = bind(
        "root", lambda r: last(keep(having(subtree("nodes", r), "section"), lambda s: f"{s}.parent = {r}.id"))
    )
    df = columns(df, _closing=f"if(_root.theme, {closing}, null)")
    df = columns(df, _cta=f"if(_closing is not null and {is_call_to_action('_closing', site)}, _closing.id, -1)")
    below = subtree("nodes", "root")
    removed = bind("_cta", lambda cta: keep(below, lambda n: f"{is_removed(n)} or {n}.id = {cta}"))
    df = columns(df, visible=overlay("nodes", each(removed, mark)))
    heads = each(
        having("visible", *HEADINGS),
        lambda h: struct(
            id=f"{h}.id", end=f"{h}.end", level=f"cast(substring({h}.tag, 2, 1) as int)",
            text=joined_text("visible", h),
        ),
    )
    return columns(df, body=subtree("visible", "root"), headings=heads).drop("_root", "_closing", "_cta")


def context_of(n: str, headings: str) -> str:
    """Text of the nearest heading that starts before the node, anywhere on the page."""
    return last(keep(headings, lambda h: f"{h}.id < {n}.id")) + ".text"


def image_name(img: str) -> str:
    """Title, else alternative text, of an image standing for a link's text."""
    return strip(f"coalesce(nullif({attr(img, 'title')}, ''), {attr(img, 'alt')}, '')")


# ---- links and media -----------------------------------------------------------------------------


def links(site: Site) -> str:
    def read(a):
        image = bind(first(having(subtree("visible", a), "img")), image_name)
        return struct(
            text=either(joined_text("visible", a), image), href=attr(a, "href"), node_id=f"{a}.id",
            url=resolve_url("url", attr(a, "href")),
        )

    def finish(x):
        internal = f"({host(f'{x}.url')} = {host('url')} or contains({host(f'{x}.url')}, {q(site.host)}))"
        chapter = group(f"{x}.url", site.guide_link, 1)
        article = either(group(f"{x}.url", site.guide_link, 2), "'overview'")
        return struct(
            node_id=f"{x}.node_id", text=f"{x}.text", url=f"{x}.url", is_internal=internal,
            target_section_id=f"if({internal} and {chapter} <> '', concat_ws('/', {chapter}, {article}), null)",
        )

    anchors = keep(having("body", "a"), lambda a: f"coalesce({attr(a, 'href')}, '') <> ''")
    kept = keep(
        each(anchors, read),
        lambda x: f"{x}.text <> '' and not startswith({x}.href, '#') and not startswith({x}.href, 'javascript:')",
    )
    return each(kept, finish)


def image_source(img: str) -> str:
    """``src``; behind a ``data:`` placeholder the lazy attributes; then a following noscript image."""
    lazy = f"coalesce(nullif({attr(img, 'data-src')}, ''), {attr(img, 'data-lazy-src')}, '')"
    shown = bind(f"coalesce({attr(img, 'src')}, '')", lambda s: f"if(startswith({s}, 'data:'), {lazy}, {s})")
    sibling = first(
        keep(having("nodes", "noscript"), lambda n: f"{n}.parent = {img}.parent and {n}.id > {img}.id")
    )
    fallback = bind(first(having(subtree("nodes", sibling), "img")), lambda i: f"coalesce({attr(i, 'src')}, '')")
    found = bind(shown, lambda s: f"if({s} <> '' and not startswith({s}, 'data:'), {s}, {fallback})")
    return bind(found, lambda s: f"if(startswith({s}, 'data:'), '', {s})")


def images() -> str:
    def caption(img):
        figure = last(keep(having("visible", "figure"), lambda f: f"{f}.id < {img}.id and {f}.end >= {img}.id"))
        return joined_text("visible", first(having(subtree("visible", figure), "figcaption")))

    def read(img, headings):
        return struct(
            src=image_source(img), alt_text=f"coalesce({attr(img, 'alt')}, '')",
            title=f"nullif({attr(img, 'title')}, '')", caption=caption(img), context=context_of(img, headings),
        )

    def finish(x):
        return struct(
            url=resolve_url("url", f"{x}.src"), alt_text=f"{x}.alt_text", title=f"{x}.title",
            caption=f"{x}.caption", context=f"{x}.context",
        )

    listed = bind("headings", lambda hs: each(having("body", "img"), lambda img: read(img, hs)))
    return each(first_per_key(keep(listed, lambda x: f"{x}.src <> ''"), "src"), finish)


def video_id(frame: str) -> str:
    src = f"coalesce(nullif({attr(frame, 'src')}, ''), {attr(frame, 'data-src')}, '')"
    tried = ", ".join(f"nullif({group(src, p)}, '')" for p in rules.VIDEO_PATTERNS)
    return f"coalesce({tried})"


def videos() -> str:
    def read(frame, headings):
        return bind(
            video_id(frame),
            lambda vid: struct(
                url=f"concat('https://www.youtube.com/watch?v=', {vid})",
                embed_url=f"concat('https://www.youtube.com/embed/', {vid})",
                video_id=vid, platform="'youtube'", title=f"nullif({attr(frame, 'title')}, '')",
                context=context_of(frame, headings),
            ),
        )

    listed = bind("headings", lambda hs: each(having("body", "iframe"), lambda f: read(f, hs)))
    return first_per_key(keep(listed, lambda x: f"{x}.video_id is not null"), "video_id")


# ---- webinars and callouts -----------------------------------------------------------------------


def _announcements() -> str:
    return keep(having("body", TEXT), lambda t: matches(f"{t}.text", "(?i)In This Webinar"))


def _enclosing(n: str, *tags: str, class_pattern: str = "") -> str:
    def around(x):
        hit = f"{x}.id < {n}.id and {x}.end >= {n}.id"
        return f"{hit} and {class_like(x, class_pattern)}" if class_pattern else hit

    return last(keep(having("visible", *tags), around))


def _column_before(n: str) -> str:
    """The column that precedes the column holding ``n``."""

    def before(own):
        return last(
            keep(
                having("visible", "div"),
                lambda x: f"{x}.parent = {own}.parent and {x}.id < {own}.id and {class_like(x, 'flex_column')}",
            )
        )

    return bind(_enclosing(n, "div", class_pattern="flex_column"), before)


def _first_link(n: str, pattern: str = "") -> str:
    return first(
        keep(having(subtree("visible", n), "a"), lambda a: f"coalesce({matches(attr(a, 'href'), pattern)}, false)")
    )


def webinar_descriptions(site: Site) -> str:
    """Pairs of webinar address and the text announced in the column after its link."""

    def read(t):
        link = _first_link(_column_before(t), site.webinar_pattern)
        return struct(
            url=bind(link, lambda a: resolve_url("url", attr(a, "href"))),
            description=joined_text("visible", _enclosing(t, "h3", "h4", "p", "div")),
        )

    return keep(each(_announcements(), read), lambda x: f"{x}.url is not null")


def webinars(site: Site) -> str:
    """Expects ``descriptions`` (``webinar_descriptions``) on the row."""

    def describe(a, img, full, headings, descriptions):
        slug = group(attr(a, "href"), r"/webinar/([^/?#]+)")
        thumb = either(
            attr(img, "data-lazy-src"), attr(img, "data-src"), f"nullif({attr(img, 'src')}, '')"
        )
        return struct(
            url=full,
            title=either(
                joined_text("visible", a), image_name(img), title_case(f"replace({slug}, '-', ' ')"), "'Webinar'"
            ),
            description=last(keep(descriptions, lambda d: f"{d}.url = {full}")) + ".description",
            thumbnail_url=bind(thumb, lambda t: f"if(startswith({t}, 'data:'), null, {resolve_url('url', t)})"),
            context=bind(context_of(a, headings), lambda h: f"if(contains({h}, 'In This Webinar'), null, {h})"),
        )

    def read(a, hs, ds):
        return bind(
            first(having(subtree("visible", a), "img")),
            lambda img: bind(resolve_url("url", attr(a, "href")), lambda full: describe(a, img, full, hs, ds)),
        )

    found = keep(having("body", "a"), lambda a: f"coalesce({matches(attr(a, 'href'), site.webinar_pattern)}, false)")
    listed = bind("headings", lambda hs: bind("descriptions", lambda ds: each(found, lambda a: read(a, hs, ds))))
    return first_per_key(listed, "url")


def webinar_marks() -> str:
    """Subtrees to be replaced by a bold webinar link: image containers and announcement headings."""

    def known(link, usable, webinars):
        def find(href):
            hits = keep(webinars, lambda w: f"contains({w}.url, {href}) or contains({href}, {w}.url)")
            return f"if({usable(href)}, {first(hits)}, null)"

        return bind(bind(link, lambda a: attr(a, "href")), find)

    def bold(start, name, target, end):
        return f"concat({q('\n\n**' + start + '[')}, {name}, '](', {target}, {q(')**' + end)})"

    def container(n, ws):
        webinar = known(_first_link(n), lambda href: f"contains({href}, '/webinar/')", ws)
        return mark(n, bind(webinar, lambda w: bold("\U0001f4f9 ", f"{w}.title", f"{w}.url", "\n\n")))

    def announcement(t, ws):
        webinar = known(_first_link(_column_before(t), "(?i)/webinar/"), lambda href: f"{href} is not null", ws)
        return bind(
            _enclosing(t, "h2", "h3", "h4", "h5", "h6", "p", "div"),
            lambda h: mark(h, bold("", joined_text("visible", h), f"{webinar}.url", "\n\n")),
        )

    boxes = keep(having("body", "div"), lambda n: class_like(n, "avia-image-container"))
    marks = bind(
        "webinars",
        lambda ws: f"concat({each(boxes, lambda n: container(n, ws))}, "
        f"{each(_announcements(), lambda t: announcement(t, ws))})",
    )
    return f"array_sort({keep(marks, lambda m: f'{m}.text is not null')})"


def related(site: Site) -> str:
    def kind(full):
        return (
            f"case when not contains({full}, {q(site.host)}) then 'external' "
            f"when contains({full}, '/blog/') then 'blog' "
            f"when contains({full}, {q(site.guide_path)}) then 'internal' "
            f"when contains({full}, {q('resources.' + site.host)}) then 'resource' else {q(site.label)} end"
        )

    def read(box):
        def known(link):
            return bind(
                resolve_url("url", f"nullif({attr(link, 'href')}, '')"),
                lambda full: struct(url=full, title=joined_text("visible", link), source_type=kind(full)),
            )

        return bind(_first_link(box), known)

    boxes = keep(
        having("body", "div"),
        lambda n: f"{class_like(n, 'av_promobox')} and contains(upper({joined_text('visible', n)}), 'RELATED ARTICLE')",
    )
    found = keep(each(boxes, read), lambda x: f"{x}.url is not null")
    return keep(first_per_key(found, "url"), lambda x: f"{x}.title <> ''")


# ---- sections and concepts -----------------------------------------------------------------------


def sections() -> str:
    """One section per h2-h4; content is the paragraphs up to the next heading. Lists and tables are
    left out, and a blank heading swallows its text. Links are matched by node range."""

    def read(hs, links):
        def one(h, i):
            def within(until):
                below = f"slice(visible, {h}.id + 2, greatest({until} - {h}.id, 0))"
                paragraphs = each(having(below, "p"), lambda p: inline_markdown("visible", p))
                inside = keep(links, lambda x: f"{x}.node_id > {h}.id and {x}.node_id <= {until}")
                return struct(
                    heading=f"{h}.text", level=f"{h}.level",
                    content=strip(f"array_join({paragraphs}, {q('\n\n')})"),
                    cross_references=each(
                        inside,
                        lambda x: struct(
                            text=f"{x}.text", url=f"{x}.url", is_internal=f"{x}.is_internal",
                            target_section_id=f"{x}.target_section_id",
                        ),
                    ),
                )

            return bind(f"coalesce(get({hs}, {i} + 1).id - 1, root.end)", within)

        return keep(each(hs, one, 2), lambda s: f"{s}.heading <> ''")

    tags = ", ".join(q(t) for t in HEADINGS)
    shown = bind(
        "root", lambda r: keep("headings", lambda h: f"{h}.id > {r}.id and {h}.id <= {r}.end and get(visible, {h}.id).tag in ({tags})")
    )
    return bind("links", lambda ls: bind(shown, lambda hs: read(hs, ls)))


# What counts as a concept.
TITLE_PHRASE = r"(?U)\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\b"
DEFINITION = r"(?U)^([A-Z][a-zA-Z\s]+?)\s+(?:is|are|refers?\s+to|means?)\s+"
_STOP = ", ".join(q(w) for w in rules.STOP_WORDS)


def title_concepts(text: str) -> str:
    phrases = f"regexp_extract_all({text}, {q(TITLE_PHRASE)}, 0)"
    return keep(phrases, lambda p: f"lower({p}) not in ({_STOP}) and length({p}) > {rules.MIN_CONCEPT}")


def defined_term(text: str) -> str:
    return bind(
        strip(group(strip(text), DEFINITION)),
        lambda t: f"if({t} <> '' and length({t}) < {rules.MAX_CONCEPT}, {t}, null)",
    )


def first_concepts(found: str, n: int = rules.MAX_CONCEPTS) -> str:
    return f"slice(array_sort(array_distinct({found})), 1, {n})"


def key_concepts() -> str:
    emphasised = keep(
        each(having("body", "strong", "b", "em"), lambda n: joined_text("visible", n)),
        lambda t: f"length({t}) > {rules.MIN_CONCEPT} and length({t}) < {rules.MAX_CONCEPT} "
        f"and lower({t}) not in ({_STOP})",
    )
    defined = keep(each(having("body", TEXT), lambda t: defined_term(f"{t}.text")), lambda t: f"{t} is not null")
    return first_concepts(f"concat({title_concepts('title')}, {emphasised}, {defined})")


# ---- the whole page ------------------------------------------------------------------------------


def with_media(content: DataFrame, site: Site) -> DataFrame:
    """Adds links, images, videos, webinars and related callouts to ``with_content`` rows."""
    df = columns(
        content, links=links(site), images=images(), videos=videos(), related=related(site),
        descriptions=webinar_descriptions(site),
    )
    return columns(df, webinars=webinars(site)).drop("descriptions")


def with_webinar_links(media: DataFrame) -> DataFrame:
    """Show webinar links where they belong in the text: the node array is changed before it is
    rendered. Pages without webinars pass through."""
    df = columns(media, _marks=f"if(size(webinars) > 0, {webinar_marks()}, null)")
    df = df.withColumn("visible", F.expr(f"if(size(_marks) > 0, {overlay('visible', '_marks')}, visible)"))
    return df.withColumn("body", F.expr(subtree("visible", "root"))).drop("_marks")


def extract_links(pages: DataFrame, site: Site = Site(), whole_body: bool = False, key: str = "page_id") -> DataFrame:
    """One row per link, in page order."""
    content = columns(with_content(parse_pages(pages), site, whole_body), links=links(site))
    return parts(content, "links", key).drop("node_id")


def extract_articles(pages: DataFrame, site: Site = Site()) -> DataFrame:
    """One row per page with everything the page holds. No shuffle; ``pages`` needs ``url`` and
    ``html`` and keeps its other columns."""
    keep_columns = [c for c in pages.columns if c != "html"]
    df = with_webinar_links(with_media(with_content(parse_pages(pages), site), site))
    df = columns(df, markdown_content=page_markdown(site), sections=sections(), key_concepts=key_concepts())
    df = df.select(
        *keep_columns, "title", "markdown_content", "sections", "key_concepts",
        F.expr(each("links", lambda x: struct(
            text=f"{x}.text", url=f"{x}.url", is_internal=f"{x}.is_internal",
            target_section_id=f"{x}.target_section_id"))).alias("links"),
        "images", "videos", "webinars", "related",
    )
    return df.select(
        "*", word_count(F.col("markdown_content")).alias("word_count"),
        char_count(F.col("markdown_content")).alias("char_count"),
    )


def parts(articles: DataFrame, part: str, key: str = "page_id") -> DataFrame:
    """One row per element of a nested column, with its place in the page.

    Computed arrays are exploded with the outer form: for the plain form the optimizer adds a size
    test that it pushes down and that computes the whole array a second time."""
    listed = articles.select(key, F.posexplode_outer(part).alias("seq", "_x")).filter("seq is not null")
    return listed.select(key, "seq", "_x.*")


def rejected_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("html").isNull() | (F.length("html") == 0)).select("page_id", "url")
