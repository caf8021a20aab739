"""Small helpers to write higher-order SQL expressions as text.

Page work nests lambdas several levels deep; as text a whole expression is one call into the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

_names = count(1)


def q(value: str) -> str:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fn(body: Callable[..., str], arity: int = 1) -> str:
    """Lambda with fresh variable names."""
    names = [f"v{next(_names)}" for _ in range(arity)]
    head = names[0] if arity == 1 else f"({', '.join(names)})"
    return f"{head} -> {body(*names)}"


def each(items: str, body: Callable[..., str], arity: int = 1) -> str:
    return f"transform({items}, {fn(body, arity)})"


def keep(items: str, body: Callable[..., str], arity: int = 1) -> str:
    return f"filter({items}, {fn(body, arity)})"


def some(items: str, body: Callable[[str], str]) -> str:
    return f"exists({items}, {fn(body)})"


def bind(value: str, use: Callable[[str], str]) -> str:
    """Evaluate ``value`` once and hand it to ``use``.

    Also needed for plain columns that a lambda reads: the optimizer may inline the column's
    expression into the lambda, which would then compute it anew for every element."""
    return f"element_at(transform(array({value}), {fn(use)}), 1)"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``bind`` for Column expressions."""
    return F.element_at(F.transform(F.array(value), use), 1)


def first(items: str) -> str:
    return f"try_element_at({items}, 1)"


def last(items: str) -> str:
    return f"try_element_at({items}, -1)"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def either(*choices: str) -> str:
    """First choice that is neither null nor empty, else the last one."""
    return "coalesce(" + ", ".join([f"nullif({c}, '')" for c in choices[:-1]] + [choices[-1]]) + ")"


def matches(text: str, pattern: str) -> str:
    return f"({text} rlike {q(pattern)})"


def group(text: str, pattern: str, index: int = 1) -> str:
    return f"regexp_extract({text}, {q(pattern)}, {index})"


def sub(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, {q(pattern)}, {q(by)})"


#: What ``\s`` stands for under ``(?U)``.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: str) -> str:
    """Without white space of any kind at both ends; a pattern would be tried at every place of the text."""
    return f"btrim({text}, {q(WHITE)})"


def title_case(text: str) -> str:
    """Capital after every non-letter; ``initcap`` only knows blanks."""
    pieces = f"regexp_extract_all(lower({text}), {q(r'\p{L}+|[^\p{L}]+')}, 0)"
    return f"array_join({each(pieces, lambda p: f'concat(upper(left({p}, 1)), substring({p}, 2))')}, '')"
