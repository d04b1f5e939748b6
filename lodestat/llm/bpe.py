"""Byte pair vocabularies: how each token is made, and which tokens may stand side by side.

A sequence of tokens is the encoding of its bytes exactly when each neighbouring pair is, so a pair that is tested once
serves every text.
"""

from __future__ import annotations

import base64


class Vocabulary:
    """``ids``: bytes to id; ``made``: id to the two ids it is merged from; ``merged``: a pair of ids to its merge.

    Ids are ranks: a merge with a smaller id goes first. ``order`` gives the rank where it isn't the id.
    """

    def __init__(self, ids: dict[bytes, int], order: dict[int, int] | None = None):
        self.ids = ids
        self.rank = order or {i: i for i in ids.values()}
        self.bytes_of = {i: t for t, i in ids.items()}
        self.made: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self._together: dict[tuple[int, int], bool] = {}
        for token in sorted(ids, key=lambda t: self.rank[ids[t]]):
            self._take_apart(token)
        # Every ending of a token, with the token's id where the ending is a token that encodes itself.
        self.endings: dict[bytes, int] = {}
        for token in ids:
            for start in range(len(token)):
                self.endings.setdefault(token[start:], -1)
        for token, i in ids.items():
            if len(token) == 1 or i in self.made:
                self.endings[token] = i

    def _take_apart(self, token: bytes) -> None:
        """Find the pair whose merge is ``token``; without one, only a whole piece becomes this token."""
        me = self.ids[token]
        for cut in range(1, len(token)):
            left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
            if left is None or right is None or max(self.rank[left], self.rank[right]) >= self.rank[me]:
                continue
            if self._whole(left) and self._whole(right) and self._apart_below(left, right, self.rank[me]):
                self.made[me] = (left, right)
                self.merged[left, right] = me
                return

    def _whole(self, i: int) -> bool:
        return len(self.bytes_of[i]) == 1 or i in self.made

    def _apart_below(self, left: int, right: int, limit: float) -> bool:
        """Whether no merge before ``limit`` joins the end of ``left`` with the start of ``right``.

        Both are undone, latest merge first, as far as their touching parts; ``limit`` is the rank at which
        the touching parts cease to exist.
        """
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and self.rank[joined] < limit:
                return False
            made_left, made_right = self.made.get(left), self.made.get(right)
            if made_left is None and made_right is None:
                return True
            # At equal times the left merge goes first, so the right one still sees its parts.
            if made_right is None or (made_left is not None and self.rank[left] > self.rank[right]):
                limit, left = min(limit, self.rank[left]), made_left[1]
            else:
                limit, right = min(limit, self.rank[right] + 1), made_right[0]

    def together(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart in the encoding of their joined bytes."""
        key = (left, right)
        known = self._together.get(key)
        if known is None:
            if len(self._together) > 1_000_000:
                self._together.clear()
            known = self._together[key] = self._apart_below(left, right, float("inf"))
        return known

    @classmethod
    def from_ranks(cls, path: str) -> Vocabulary:
        """A file of lines ``base64(token) rank``."""
        with open(path, "rb") as lines:
            rows = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in rows})


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in JSON vocabularies, by letter."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
