"""Small helpers shared by the tests."""

import contextlib
import io
import re


def rows(df):
    """All rows as sorted tuples; NULLs sort first."""
    return sorted(
        (tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r]
    )


def plan(df) -> str:
    """Physical plan as text; the final one once the query has run."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue().split("== Initial Plan ==")[0]


def ancestors(text: str, leaf: str) -> list[list[str]]:
    """For each plan node whose line holds ``leaf``, the nodes above it, top first."""
    found, path = [], []
    for line in text.splitlines():
        match = re.match(r"^([\s:+\-|]*)(\S.*)$", line)
        if not match or line.startswith("=="):
            continue
        depth = len(match[1])
        path = [(d, n) for d, n in path if d < depth]
        if leaf in match[2]:
            found.append([n for _, n in path])
        path.append((depth, match[2]))
    return found


def exchanges(text: str, leaf: str) -> list[list[str]]:
    """The shuffles and broadcasts on the way from each such leaf to the result."""
    return [[n for n in path if "Exchange" in n.split("(")[0]] for path in ancestors(text, leaf)]
