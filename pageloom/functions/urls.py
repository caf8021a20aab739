"""Relative-reference resolution and host tests as SQL expressions (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.sql import bind, group, matches, q, sub

SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
AUTHORITY = r"^([A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def host(url: str) -> str:
    """Network location, port included; empty when there is none."""
    return group(url, AUTHORITY, 2)


def _drop_dot_segments(path: str) -> str:
    fold = (
        "(acc, seg) -> case seg when '.' then acc when '..' then slice(acc, 1, greatest(size(acc) - 1, 1)) "
        "else concat(acc, array(seg)) end"
    )
    folded = bind(f"split({path}, '/')", lambda s: f"aggregate(slice({s}, 2, size({s})), array(''), {fold})")
    return f"concat(array_join({folded}, '/'), if({matches(path, r'/\.{1,2}\z')}, '/', ''))"


def resolve_url(base: str, ref: str) -> str:
    """Resolve the reference expression ``ref`` against the page address expression ``base``."""
    scheme = group(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    no_query = group(base, r"^[^?#]*", 0)
    folder = sub(sub(no_query, AUTHORITY), r"[^/]*\z")
    ref_path = group(ref, r"^[^?#]*", 0)
    joined = f"if(startswith({ref_path}, '/'), {ref_path}, concat({bind(folder, lambda f: f'''if({f} = '', '/', {f})''')}, {ref_path}))"
    path = bind(joined, lambda p: f"if({matches(p, r'/\.{1,2}(/|\z)')}, {_drop_dot_segments(p)}, {p})")
    return (
        f"case when {ref} = '' then {base} when {matches(ref, SCHEME)} then {ref} "
        f"when startswith({ref}, '//') then concat({scheme}, {ref}) "
        f"when startswith({ref}, '#') then concat({group(base, '^[^#]*', 0)}, {ref}) "
        f"when startswith({ref}, '?') then concat({no_query}, {ref}) "
        f"when {ref} is not null then concat({scheme}, '//', {host(base)}, {path}, {sub(ref, r'^[^?#]*')}) end"
    )


def fix_typos(url: Column, fixes: dict[str, str]) -> Column:
    """Apply a small map of known address typos."""
    for wrong, right in fixes.items():
        url = F.replace(url, F.lit(wrong), F.lit(right))
    return url
