"""Event-driven XML reading, for every document size.

A document is a stream: it is read in chunks through expat, no tree is built.
An element that starts a record opens a *form*; while it is open it is told of
every start and end below it and says where the text of an element goes.  A
form closes with its element and gives its records; they leave in the order in
which their elements opened.  So memory follows the open forms, not the
document.

A document is checked for well-formedness in a first pass (expat alone), so a
broken one gives no record at all although nothing is held back.  Text is what
stands before an element's first child; comments and processing instructions
do not count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import BinaryIO, Protocol
from xml.parsers import expat

CHUNK = 1 << 16
#: Tags whose names are kept at once.
MOST_NAMES = 1 << 10
#: What makes a document malformed: expat's errors, and unknown or unsupported encodings.
MALFORMED = (expat.ExpatError, LookupError, ValueError)

#: Where a text goes: a dict and its key.
Target = tuple[dict, str]


class Form(Protocol):
    """An open record.  ``level`` counts from the record's element (0)."""

    def start(self, level: int, name: str, attrs: dict) -> Target | None: ...
    def end(self, level: int) -> None: ...
    def close(self) -> list[tuple[str, dict]]: ...


def _parser() -> expat.XMLParserType:
    p = expat.ParserCreate(namespace_separator="}")
    p.buffer_text = True
    return p


def check(stream: BinaryIO) -> None:
    """Raise one of ``MALFORMED`` unless the stream is well-formed XML."""
    p = _parser()
    while chunk := stream.read(CHUNK):
        p.Parse(chunk, False)
    p.Parse(b"", True)


def read(stream: BinaryIO, name_of: Callable[[str], str],
         open_form: Callable[[str, dict], Form | None]) -> Iterator[tuple[str, dict]]:
    """(record type, fields) of the forms that ``open_form`` opens."""
    depth, count = 0, 0
    forms: list[tuple[int, int, Form]] = []        # (depth, opening order, form)
    closed: list[tuple[int, list]] = []
    targets: list[Target] = []
    text: list[str] = []
    names: dict[str, str] = {}                     # of the tags met lately

    def settle() -> None:
        value = "".join(text) or None
        for where, key in targets:
            where[key] = value
        targets.clear()
        text.clear()

    def start(tag: str, attrs: dict) -> None:
        nonlocal depth, count
        if targets:
            settle()
        depth += 1
        name = names.get(tag)
        if name is None:
            if len(names) >= MOST_NAMES:
                names.clear()
            name = names[tag] = name_of(tag)
        for at, _, form in forms:
            target = form.start(depth - at, name, attrs)
            if target:
                targets.append(target)
        form = open_form(name, attrs)
        if form is not None:
            forms.append((depth, count, form))
            count += 1

    def end(_tag: str) -> None:
        nonlocal depth
        if targets:
            settle()
        for at, _, form in forms:
            form.end(depth - at)
        if forms and forms[-1][0] == depth:
            _, order, form = forms.pop()
            closed.append((order, form.close()))
        depth -= 1

    p = _parser()
    p.StartElementHandler, p.EndElementHandler = start, end
    p.CharacterDataHandler = lambda data: text.append(data) if targets else None

    def done() -> Iterator[tuple[str, dict]]:
        if not forms and closed:
            for _, records in sorted(closed, key=lambda c: c[0]):
                yield from records
            closed.clear()
    while chunk := stream.read(CHUNK):
        p.Parse(chunk, False)
        yield from done()
    p.Parse(b"", True)
    yield from done()


def local_name(tag: str) -> str:
    return tag.rpartition("}")[2]
