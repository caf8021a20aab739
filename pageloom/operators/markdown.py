"""Markdown from node arrays.

A block is the outermost node that is no container; its inline text is the in-order run of opening
marks, texts and closing marks of its subtree. Where nested elements strip their text, the run
carries Unicode noncharacters as edge marks, and a few regular expressions finish the job.
"""

from __future__ import annotations

from pageloom.functions.sql import bind, each, either, first, keep, matches, q, some, strip, struct, sub
from pageloom.operators import rules
from pageloom.operators.dom import TEXT, attr, having, joined_text, raw_text, subtree
from pageloom.operators.rules import Site

# Edge marks: open/close of a stripped text, of one without visible marks, and of a link.
OPEN, CLOSE, HUSH, UNHUSH = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3"
LINK, HREF, UNLINK = "\ufdd4", "\ufdd5", "\ufdd6"
INLINE_PARENTS = r"^(/(strong|b|em|i|u|span|a))*/[^/]+\z"


def below_path(n: str, top: str) -> str:
    """Path of ``n`` relative to its ancestor ``top``."""
    return f"substring({n}.path, length({top}.path) + 1)"


def image_markdown(img: str) -> str:
    from pageloom.operators.extract import image_source

    name = either(attr(img, "alt"), attr(img, "title"), "'Image'")
    return bind(image_source(img), lambda src: f"if({src} = '', '', concat('![', {name}, '](', {src}, ')'))")


def frame_markdown(frame: str) -> str:
    from pageloom.operators.extract import video_id

    name = bind(
        strip(f"coalesce({attr(frame, 'title')}, '')"),
        lambda t: f"if({t} = '' or lower({t}) = 'youtube video player', 'YouTube Video', {t})",
    )
    link = f"concat('\U0001f3ac [', {name}, '](https://www.youtube.com/watch?v=', {video_id(frame)}, ')')"
    return f"coalesce({link}, '')"


def _finish_inline(run: str) -> str:
    hush = rf"(?U){HUSH}\s*{UNHUSH}"
    run = sub(sub(run, hush), hush)
    run = sub(run, rf"(?U){LINK}[\s{HUSH}{UNHUSH}]*{HREF}[^{UNLINK}]*{UNLINK}")
    run = sub(f"concat({q(OPEN)}, {run}, {q(CLOSE)})", rf"(?U)([{OPEN}{HUSH}{LINK}])\s+", "$1")
    run = sub(run, rf"(?U)\s+([{CLOSE}{UNHUSH}{HREF}])", "$1")
    run = sub(run, f"[{OPEN}{CLOSE}{HUSH}{UNHUSH}]")
    run = sub(run, rf"{LINK}([^{LINK}{HREF}{UNLINK}]*){HREF}{UNLINK}", "$1")
    return sub(run, rf"{LINK}([^{LINK}{HREF}{UNLINK}]*){HREF}([^{UNLINK}]+){UNLINK}", "[$1]($2)")


def inline_markdown(visible: str, top: str) -> str:
    def rendered(below):
        pictured = keep(having(below, "a"), lambda a: some(subtree(visible, a), lambda x: f"{x}.tag = 'img'"))
        return bind(pictured, lambda framed: _inline_run(visible, top, below, framed))

    return bind(subtree(visible, top), rendered)


def _inline_run(visible: str, top: str, below: str, pictured: str) -> str:
    """``pictured`` are the links that wrap an image; they show the image's name instead."""

    def drawn(x):
        return f"not {some(pictured, lambda a: f'{x}.id > {a}.id and {x}.id <= {a}.end')}"

    def live(x):
        return matches(below_path(x, top), INLINE_PARENTS)

    def picture_name(a):
        named = bind(
            first(having(subtree(visible, a), "img")),
            lambda img: strip(either(attr(img, "title"), attr(img, "alt"), "'Link'")),
        )
        return f"if({some(pictured, lambda p: f'{p}.id = {a}.id')}, {named}, '')"

    def event(at, side, depth, text):
        return struct(at=at, side=side, depth=depth, s=text)

    def opening(x):
        shown = (
            f"case when {x}.tag = {q(TEXT)} then {x}.text when not {live(x)} then '' "
            f"when {x}.tag in ('strong', 'b') then {q('**' + OPEN)} when {x}.tag in ('em', 'i') then {q('*' + OPEN)} "
            f"when {x}.tag in ('u', 'span') then {q(HUSH)} when {x}.tag = 'code' then '`' "
            f"when {x}.tag = 'a' then concat({q(LINK)}, {picture_name(x)}) when {x}.tag = 'br' then {q('\n')} "
            f"when {x}.tag = 'img' then {image_markdown(x)} else '' end"
        )
        return event(f"{x}.id", "0", "0", shown)

    def closing(x):
        href = f"coalesce({attr(x, 'href')}, '')"
        shown = (
            f"case when {x}.tag in ('strong', 'b') then {q(CLOSE + '**')} "
            f"when {x}.tag in ('em', 'i') then {q(CLOSE + '*')} when {x}.tag in ('u', 'span') then {q(UNHUSH)} "
            f"when {x}.tag = 'code' then '`' else concat({q(HREF)}, {href}, {q(UNLINK)}) end"
        )
        return event(f"{x}.end", "1", f"-{x}.id", shown)

    def marked(x):
        return f"{x}.tag in ('strong', 'b', 'em', 'i', 'u', 'span', 'code', 'a') and {live(x)}"

    def written(events):
        return f"array_join({each(events, lambda e: f'{e}.s')}, '')"

    def run(shown):
        return bind(
            each(shown, opening),
            lambda opens: bind(
                keep(shown, marked),
                lambda ends: f"if(size({ends}) = 0, {strip(written(opens))}, "
                f"{_finish_inline(written(f'array_sort(concat({opens}, {each(ends, closing)}))'))})",
            ),
        )

    return bind(keep(below, drawn), run)


def table_markdown(visible: str, table: str) -> str:
    below = subtree(visible, table)
    body = f"coalesce({first(having(below, 'tbody'))}, {table})"

    def cells(tr):
        return each(having(subtree(visible, tr), "th", "td"), lambda c: joined_text(visible, c))

    def line(values):
        return f"concat('| ', array_join({values}, ' | '), ' |')"

    def ruler(values):
        return line(f"array_repeat('---', size({values}))")

    head = cells(first(having(subtree(visible, first(having(below, "thead"))), "tr")))
    rows = keep(each(having(subtree(visible, body), "tr"), cells), lambda r: f"size({r}) > 0")

    def drawn(hd, rs):
        lines = each(rs, line)
        return (
            f"case when {hd} is not null then array_join(concat(array({line(hd)}, {ruler(hd)}), {lines}), {q('\n')}) "
            f"when size({rs}) > 0 then array_join(concat(array({line(f'{rs}[0]')}, {ruler(f'{rs}[0]')}), "
            f"slice({lines}, 2, size({rs}))), {q('\n')}) else '' end"
        )

    return bind(head, lambda hd: bind(rows, lambda rs: drawn(hd, rs)))


def block_markdown(visible: str, n: str) -> str:
    items = each(
        keep(having(subtree(visible, n), "li"), lambda x: f"{x}.parent = {n}.id"),
        lambda li: inline_markdown(visible, li),
    )

    def listed(ts):
        plain = each(ts, lambda t: f"concat('- ', {t})")
        numbered = each(ts, lambda t, i: f"concat({i} + 1, '. ', {t})", 2)
        return f"array_join(if({n}.tag = 'ul', {plain}, {numbered}), {q('\n')})"

    def run(text):
        return f"if({n}.tag = 'p', {text}, concat('> ', replace({text}, {q('\n')}, {q('\n> ')})))"

    def fence(code):
        named = first(keep(f"split({attr(code, 'class')}, {q(r'\s+')})", lambda c: f"startswith({c}, 'language-')"))
        language = f"coalesce({sub(named, '^language-')}, '')"
        inner = raw_text(visible, f"coalesce({code}, {n})")
        return f"concat('```', {language}, {q('\n')}, {inner}, {q('\n```')})"

    return (
        f"case when {n}.tag = {q(TEXT)} then {strip(f'{n}.text')} "
        f"when {n}.tag in ('p', 'blockquote') then {bind(inline_markdown(visible, n), run)} "
        f"when {matches(f'{n}.tag', '^h[1-6]$')} then "
        f"concat(repeat('#', try_cast(substring({n}.tag, 2, 1) as int)), ' ', {joined_text(visible, n)}) "
        f"when {n}.tag in ('ul', 'ol') then {bind(items, listed)} "
        f"when {n}.tag = 'img' then {image_markdown(n)} when {n}.tag = 'iframe' then {frame_markdown(n)} "
        f"when {n}.tag = 'pre' then {bind(first(having(subtree(visible, n), 'code')), fence)} "
        f"when {n}.tag = 'table' then {table_markdown(visible, n)} else {joined_text(visible, n)} end"
    )


def root_markdown() -> str:
    """Blocks of the content root joined by blank lines; needs ``root``, ``nodes``, ``visible``, ``body``."""
    held = "^(/(" + "|".join(rules.CONTAINERS) + r"))*/[^/]+\z"
    containers = ", ".join(q(c) for c in rules.CONTAINERS)
    blocks = bind(
        "root", lambda r: keep("body", lambda n: f"{n}.tag not in ('', {containers}) and {matches(below_path(n, r), held)}")
    )
    texts = keep(each(blocks, lambda n: block_markdown("visible", n)), lambda t: f"{strip(t)} <> ''")
    return strip(sub(f"array_join({texts}, {q('\n\n')})", r"\n{3,}", "\n\n"))


# How promotional passages of a text are known.
PROMO_START = r"(?i)^#{1,4}\s*(Ready to Find Out More|Book a Demo)"
ANY_HEADING = r"(?U)^#{1,4}\s+"
PROMO_WORD = r"(?i)(demo|trial|contact|pricing)"


def drop_promo_text(markdown: str, site: Site) -> str:
    """Drop everything from a promotional heading up to the next ordinary heading, and single
    promotional lines anywhere."""
    lines = each(
        f"split({markdown}, {q('\n')})",
        lambda s, i: struct(
            i=i, s=s, starts=f"startswith({s}, '#') and {matches(s, PROMO_START)}",
            stops=f"startswith({s}, '#') and {matches(s, ANY_HEADING)} and not {matches(s, PROMO_WORD)} and not {matches(s, PROMO_START)}",
        ),
        2,
    )

    def spans(ls, stops):
        return each(
            keep(ls, lambda x: f"{x}.starts"),
            lambda x: struct(
                a=f"{x}.i", b=f"coalesce({first(keep(stops, lambda b: f'{b} > {x}.i'))}, size({ls}))"
            ),
        )

    def outside(ls, cuts):
        def inside(x):
            return some(cuts, lambda c: f"{x}.i >= {c}.a and {x}.i < {c}.b")

        return keep(ls, lambda x: f"not {inside(x)} and not {matches(f'{x}.s', site.promo_text)}")

    def kept(ls):
        stops = each(keep(ls, lambda x: f"{x}.stops"), lambda x: f"{x}.i")
        cuts = bind(stops, lambda bs: spans(ls, bs))
        return each(bind(cuts, lambda cs: outside(ls, cs)), lambda x: f"{x}.s")

    joined = f"array_join({bind(lines, kept)}, {q('\n')})"
    return strip(sub(joined, r"\n{3,}", "\n\n"))


def page_markdown(site: Site) -> str:
    return drop_promo_text(root_markdown(), site)
