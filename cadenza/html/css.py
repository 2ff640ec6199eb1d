"""CSS selectors: tags, #id, .class, [attr], [attr=v] and its ^ $ * ~ | forms, :first-of-type, :last-of-type,
:first-child, :last-child, :nth-child(n), :nth-of-type(n), :not(simple), descendant, >, + and ~ combinators, lists."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from cadenza.html.tree import Node

_PART = re.compile(r"""\s*([>+~,])\s*|(\s+)|(\*|[\w-]+)|\#([\w-]+)|\.([\w-]+)|\[\s*([\w-]+)\s*(?:([~|^$*]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+))\s*)?\]|:([\w-]+)(?:\(([^()]*(?:\([^()]*\)[^()]*)*)\))?""")
Test = Callable[[Node], bool]


def _attribute(name: str, op: str | None, value: str) -> Test:
    checks: dict[str | None, Callable[[str], bool]] = {
        None: lambda v: True, "=": lambda v: v == value, "~=": lambda v: value in v.split(), "|=": lambda v: v == value or v.startswith(value + "-"),
        "^=": lambda v: bool(value) and v.startswith(value), "$=": lambda v: bool(value) and v.endswith(value), "*=": lambda v: bool(value) and value in v,
    }
    return lambda n: name in n.attrs and checks[op](n.attrs[name])


def _nth(argument: str) -> Callable[[int], bool]:
    a = {"odd": "2n+1", "even": "2n"}.get(argument.strip(), argument.replace(" ", ""))
    m = re.fullmatch(r"([+-]?\d*)n([+-]\d+)?|(\d+)", a)
    if not m:
        raise ValueError(f"bad position {argument!r}")
    if m[3]:
        return lambda i: i == int(m[3])
    step, first = int(m[1] + "1" if m[1] in ("", "+", "-") else m[1]), int(m[2] or 0)
    return lambda i: i == first if step == 0 else (i - first) % step == 0 and (i - first) // step >= 0


def _pseudo(name: str, argument: str | None) -> Test:
    of_type = lambda n: [s for s in n.siblings() if s.name == n.name]
    if name == "not":
        inner = compiled(argument or "")
        return lambda n: not any(_matches(n, c) for c in inner)
    simple: dict[str, Test] = {
        "first-of-type": lambda n: of_type(n)[0] is n, "last-of-type": lambda n: of_type(n)[-1] is n, "only-of-type": lambda n: len(of_type(n)) == 1,
        "first-child": lambda n: n.siblings()[0] is n, "last-child": lambda n: n.siblings()[-1] is n, "only-child": lambda n: len(n.siblings()) == 1, "empty": lambda n: not n.children,
    }
    if name in simple:
        return simple[name]
    if name in ("nth-child", "nth-of-type"):
        fits = _nth(argument or "")
        return lambda n: fits(1 + next(i for i, s in enumerate(of_type(n) if name == "nth-of-type" else n.siblings()) if s is n))
    if name == "contains":
        wanted = (argument or "").strip("\"'")
        return lambda n: wanted in n.text()
    raise ValueError(f"unknown pseudo-class :{name}")


@functools.lru_cache(maxsize=4096)
def compiled(selector: str) -> list[list[tuple[str, list[Test]]]]:
    """Alternatives, each a list of (combinator before, tests) from left to right."""
    out: list[list[tuple[str, list[Test]]]] = [[("", [])]]
    text, at = selector.strip(), 0
    if not text:
        raise ValueError("empty selector")
    while at < len(text):
        m = _PART.match(text, at)
        if not m or m.end() == at:
            raise ValueError(f"bad selector {selector!r}")
        at = m.end()
        combinator = m[1] or (" " if m[2] else None)
        if combinator == ",":
            out.append([("", [])])
        elif combinator:
            out[-1].append((combinator, []))
        else:
            tests = out[-1][-1][1]
            if m[3]:
                tests.append((lambda n: True) if m[3] == "*" else (lambda n, t=m[3].lower(): n.name == t))
            elif m[4]:
                tests.append(lambda n, i=m[4]: n.attrs.get("id") == i)
            elif m[5]:
                tests.append(lambda n, c=m[5]: c in n.classes())
            elif m[6]:
                tests.append(_attribute(m[6].lower(), m[7], next((v for v in (m[8], m[9], m[10]) if v is not None), "")))
            else:
                tests.append(_pseudo(m[11], m[12]))
    if any(not tests for alternative in out for _, tests in alternative):
        raise ValueError(f"bad selector {selector!r}")
    return out


def _matches(n: Node, parts: list[tuple[str, list[Test]]], last: int | None = None) -> bool:
    i = len(parts) - 1 if last is None else last
    combinator, tests = parts[i]
    if not all(t(n) for t in tests):
        return False
    if i == 0:
        return True
    if combinator in (" ", ">"):
        up = n.parent
        while up is not None and up.parent is not None:
            if _matches(up, parts, i - 1):
                return True
            if combinator == ">":
                return False
            up = up.parent
        return False
    before = n.siblings()
    place = next(k for k, s in enumerate(before) if s is n)
    candidates = before[place - 1 : place] if combinator == "+" else before[:place]
    return any(_matches(s, parts, i - 1) for s in candidates)


def select(root: Node, selector: str) -> list[Node]:
    """Elements below ``root`` that match, in document order."""
    alternatives = compiled(selector)
    return [n for n in root.elements() if any(_matches(n, a) for a in alternatives)]


def select_one(root: Node, selector: str) -> Node | None:
    alternatives = compiled(selector)
    return next((n for n in root.elements() if any(_matches(n, a) for a in alternatives)), None)
