"""Texts cut into the pieces that byte-level tokenisers merge within, and the results for pieces already met.

The split pattern never takes a character that isn't white space together with white space after it. So each place
between the two (``BOUNDARY``) ends a piece, whatever stands on either side. Pieces repeat a lot; a task keeps
the results of those it has met.
"""

from __future__ import annotations

import re

import regex

# Unicode's White_Space, fixed by the standard.
WHITE_SPACE = "\t-\r \x85\xa0  -     　"
# The split pattern of the public vocabularies, fixed by their format.
SPLIT = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
)
BOUNDARY = re.compile(rf"(?<=[^{WHITE_SPACE}])(?=[{WHITE_SPACE}])")

pieces = SPLIT.findall


class Remembered(dict):
    """Results by piece, filled for many texts at once; emptied when it holds ``room`` of them."""

    def __init__(self, work, room: int = 300_000):
        super().__init__()
        self.work, self.room = work, room

    def cover(self, wanted: set[str]) -> None:
        """Have a result for each of ``wanted``; ``work`` gets the missing ones in order, and yields one for each."""
        missing = [piece for piece in wanted if piece not in self]
        if len(self) + len(missing) > self.room:
            self.clear()
            missing = wanted
        missing = sorted(missing)
        self.update(zip(missing, self.work(missing)))


def portions(texts, characters: int = 2_000_000):
    """Runs of consecutive texts of about so many characters, so that a task's memory doesn't follow its batches."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= characters:
            yield run
            run, size = [], 0
    if run:
        yield run
