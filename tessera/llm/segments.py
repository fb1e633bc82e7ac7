"""Cutting texts where a tokenizer cannot join tokens, and a bounded cache of the parts.

A cut is placed before a space that follows a character other than white space.
Vocabularies whose tokens hold spaces only at their start (checked for each) never
merge across such a cut, so the tokens of a text are those of its segments.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: Texts where a plain split at spaces would cut inside a run of white space.
_RUN = re.compile(r" (?:(?<=[\s▁\x1c-\x1f\x85] )|\Z)")
_SEGMENT = re.compile(r" +[^ ]*|[^ ]+")
_SPACE_AFTER_SPACE = re.compile(r"[\s▁\x1c-\x1f\x85]\Z")


def segments(text: str) -> list[str]:
    """Parts of ``text`` that join to it; all but the first start with a space.

    In the usual case (single spaces between words) a part is `` word``. Where
    white space meets a space, the parts around it stay together.
    """
    first, *rest = text.split(" ")
    if not _RUN.search(text):
        return [first, *[" " + w for w in rest]] if first else [" " + w for w in rest]
    out: list[str] = []
    for part in _SEGMENT.findall(text):
        if out and _SPACE_AFTER_SPACE.search(out[-1]):
            out[-1] += part
        else:
            out.append(part)
    return out


class SegmentCache:
    """Values of segments, computed for many missing ones at a time.

    A generation of more than ``limit`` segments becomes the old one: what is met again moves on, the rest goes
    with the next change. Segments over ``longest`` code points are not kept after their group of texts. Both
    bound its memory; kept by a worker process, it outlives a task.
    """

    def __init__(self, values_of: Callable[[list[str]], list], limit: int = 400_000, longest: int = 48):
        self._values_of, self._limit, self._longest = values_of, limit, longest
        self._kept: dict[str, object] = {}
        self._old: dict[str, object] = {}
        self._passing: list[str] = []

    def look_up(self, parts: list[list[str]]) -> dict[str, object]:
        """A mapping that holds the value of every segment in ``parts``."""
        if len(self._kept) > self._limit:
            self._kept, self._old = {}, self._kept
        for long in self._passing:
            self._kept.pop(long, None)
            self._old.pop(long, None)
        wanted = set().union(*parts).difference(self._kept)
        missing = list(wanted.difference(self._old))
        for s in wanted.intersection(self._old):
            self._kept[s] = self._old[s]
        self._kept.update(zip(missing, self._values_of(missing), strict=True))
        self._passing = [s for s in missing if len(s) > self._longest]
        return self._kept


def in_groups(texts: list[str], most: int = 1_000_000):
    """Consecutive texts, together about ``most`` code points or one longer text."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > most:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group
