"""Finding spans in whole texts: exact patterns plus a trained tagger.

A *finder* knows its kinds, finds the exact spans of each kind and turns a token
into features. This module holds what personal data and secrets have in common:
cutting texts into tokens, tagging the texts of a batch together, and merging
the tagger's spans with the exact ones, which always stay.

Every token of a text takes part in the tagging; no rule decides beforehand
which tokens may belong to a span. A token's score is the sum of what it adds
itself and of what the two tokens on either side add, across line breaks. Most
tokens are proven outside by their scores alone (:meth:`Crf.undecided`); Viterbi
runs on the others, with the result of a run over the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_RE, small_batches
from .crf import Crf

Span = tuple[str, int, int]
# Remembered tokens: at most this many, of this many characters together and
# with this many different weights, beyond those of one text.
CACHE_TOKENS = 400_000
CACHE_CHARS = 8_000_000
CACHE_ROWS = 50_000
# Tokens scored at a time, and cells that wait to be decoded together.
BLOCK_TOKENS = 1 << 16
WAITING_CELLS = 1 << 20
# Places around a token whose tokens have a say in its score.
PLACES = (0, -1, 1, -2, 2)
_PLAIN = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF][a-z\u00DF-\u00F6\u00F8-\u00FF]*")
_MARK = re.compile(r"\{(\w+) ([^}]*)\}")


def read_labelled(table: str) -> Iterator[tuple[str, list[Span]]]:
    """Lines of text with spans marked as ``{kind text}``."""
    for line in table.strip().split("\n"):
        text, spans, at = "", [], 0
        for m in _MARK.finditer(line):
            text += line[at:m.start()]
            spans.append((m[1], len(text), len(text) + len(m[2])))
            text += m[2]
            at = m.end()
        yield text + line[at:], spans


class Finder:
    """Base of the finders. ``kinds`` are listed in their sort order."""

    kinds: tuple[str, ...] = ()
    tagged_kinds: tuple[str, ...] = ()
    labelled = ""
    # Characters that are cut from both sides of a token.
    edges = ""

    def exact(self, text: str) -> list[Span]:
        raise NotImplementedError

    def own(self, token: str) -> list[str]:
        """Features of a token; its neighbours see them with a prefix."""
        raise NotImplementedError

    def is_special(self, word: str) -> bool:
        """Whether a word of small letters has features by its letters, not
        only by its shape and length."""
        return False

    def far(self, features: list[str]) -> list[str]:
        """Those features that tokens two places away see, too."""
        return []

    def whole(self, text: str) -> list[str]:
        """Features of the text that every token of it has."""
        return []

    def trim(self, kind: str, text: str, start: int, end: int) -> Span | None:
        """The final borders of a tagged span, or None to drop it."""
        raise NotImplementedError

    # ------------------------------------------------------------- training

    def train(self) -> "Finder":
        labels = [f"{b}-{k}" for k in self.tagged_kinds for b in "BI"]
        sequences, tags = [], []
        for text, spans in read_labelled(self.labelled):
            tokens = [(m.start(), m.end()) for m in WORD_RE.finditer(text)]
            words = [text[s:e] for s, e in tokens]
            row, whole = [], self.whole(text)
            open_span = None
            for s, e in tokens:
                span = next((x for x in spans if s < x[2] and e > x[1]), None)
                row.append("O" if span is None else f"{'I' if span == open_span else 'B'}-{span[0]}")
                open_span = span
            seen = [self._seen(w) for w in ("", "", *words, "", "")]
            sequences.append([[*(f for k, at in enumerate(PLACES) for f in seen[i + 2 + at][k]), *whole, "any"]
                              for i in range(len(words))])
            tags.append(row)
        self.crf = Crf(labels).fit(sequences, tags)
        self._any = self.crf.score(["any"])
        self._known: _Known | None = None
        return self

    def _seen(self, token: str) -> list[list[str]]:
        """The features that a token gives to each of PLACES: to itself, to the
        tokens after and before it, to those two places after and before it."""
        own = self.own(token) if token else ["edge"]
        far = self.far(own)
        return [own, [f"<{f}" for f in own], [f">{f}" for f in own], [f"<<{f}" for f in far], [f">>{f}" for f in far]]

    def is_plain(self, core: str) -> bool:
        """Whether a token has the same weights as any other Latin word in
        small letters, or with a capital, of its length."""
        if not _PLAIN.fullmatch(core):
            return False
        low = core.lower()
        return f"w={low}" not in self.crf.index and not self.is_special(low)

    # -------------------------------------------------------------- tagging

    def _undecided(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, scores) of the tokens of a text not proven outside."""
        known = self._known
        if known is None or known.full():
            known = self._known = _Known(self)
        ids = np.array([0, 0, *map(known.__getitem__, WORD_RE.findall(text)), 0, 0], dtype=np.int64)
        n = len(ids) - 4
        always = self._any + self.crf.score(self.whole(text))

        def scores(tokens: np.ndarray) -> np.ndarray:
            return sum(known.tables[k][ids[tokens + (2 + at)]] for k, at in enumerate(PLACES)) + always

        most = [self.crf.most(scores(np.arange(b, min(n, b + BLOCK_TOKENS)))) for b in range(0, n, BLOCK_TOKENS)]
        numbers = self.crf.undecided(np.concatenate([np.empty(0), *most]))
        return numbers, scores(numbers)

    def tag(self, texts: list[str]) -> list[list[Span]]:
        """The tagger's spans of each text."""
        out: list[list[Span]] = [[] for _ in texts]
        waiting: list[tuple[int, list[tuple[int, int]], np.ndarray]] = []
        cells = 0
        for d, text in enumerate(texts):
            numbers, scores = self._undecided(text)
            if len(numbers):
                tokens = [m.span() for m in WORD_RE.finditer(text)]
                cuts = [0, *(np.flatnonzero(np.diff(numbers) > 1) + 1).tolist(), len(numbers)]
                for b, e in zip(cuts, cuts[1:]):
                    first = int(numbers[b])
                    waiting.append((d, tokens[first:first + e - b], scores[b:e]))
                cells += scores.size
            if cells > WAITING_CELLS or d + 1 == len(texts):
                self._decode(texts, waiting, out)
                waiting, cells = [], 0
        return out

    def _decode(self, texts: list[str], waiting: list[tuple[int, list[tuple[int, int]], np.ndarray]],
                out: list[list[Span]]) -> None:
        for (d, tokens, _), path in zip(waiting, self.crf.decode([scores for _, _, scores in waiting])):
            if not path.any():
                continue
            open_kind, begin, end = None, 0, 0
            for (s, e), label in zip([*tokens, (0, 0)], [*path.tolist(), 0]):
                name = self.crf.labels[label]
                if open_kind is not None and name == f"I-{open_kind}":
                    end = e
                    continue
                if open_kind is not None:
                    span = self.trim(open_kind, texts[d], begin, end)
                    if span:
                        out[d].append(span)
                open_kind, begin, end = (None if name == "O" else name[2:]), s, e

    def find(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """(exact spans, all spans) of each text, sorted by start, then kind.
        A tagged span that touches an exact one is dropped."""
        result = []
        rank = {k: i for i, k in enumerate((*self.kinds, *self.tagged_kinds)[::-1])}
        rank = {k: -i for k, i in rank.items()}
        for text, tagged in zip(texts, self.tag(texts)):
            exact = sorted(self.exact(text), key=lambda x: (x[1], rank[x[0]]))
            merged = list(exact)
            if tagged:
                if exact:
                    # Exact spans of several kinds can overlap, so ends are
                    # taken as running maxima for the search.
                    begins = np.array([x[1] for x in exact])
                    ends = np.maximum.accumulate(np.array([x[2] for x in exact]))
                    for span in tagged:
                        k = int(np.searchsorted(begins, span[2], side="left"))
                        if k == 0 or ends[k - 1] <= span[1]:
                            merged.append(span)
                else:
                    merged += tagged
                merged.sort(key=lambda x: (x[1], rank[x[0]]))
            result.append((exact, merged))
        return result


class _Known(dict):
    """Rows of the tokens met so far in a table for each of PLACES, which holds
    what they add there. Row 0 is the edge of a text. Plain words share the row
    of a word of as many q."""

    def __init__(self, finder: Finder):
        self._finder, self._rows, self._chars = finder, 0, 0
        self._plain: dict[tuple[str, bool, int, str], int] = {}
        self.tables = [np.zeros((1024, len(finder.crf.labels))) for _ in PLACES]
        self[""]

    def full(self) -> bool:
        return len(self) > CACHE_TOKENS or self._chars > CACHE_CHARS or self._rows > CACHE_ROWS

    def __missing__(self, token: str) -> int:
        core = token.strip(self._finder.edges)
        if core and self._finder.is_plain(core):
            at = token.index(core)
            like = (token[:at], core[0].islower(), len(core), token[at + len(core):])
            row = self._plain.get(like)
            if row is None:
                row = self._plain[like] = self._new(f"{like[0]}{'q' if like[1] else 'Q'}{'q' * (len(core) - 1)}{like[3]}")
        else:
            row = self._new(token)
        self._chars += len(token)
        self[token] = row
        return row

    def _new(self, token: str) -> int:
        row = self._rows
        if row == len(self.tables[0]):
            self.tables = [np.concatenate([t, np.zeros_like(t)]) for t in self.tables]
        for table, features in zip(self.tables, self._finder._seen(token)):
            table[row] = self._finder.crf.score(features)
        self._rows += 1
        return row


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_spans(docs: DataFrame, finder: Finder) -> DataFrame:
    """(doc_id, n_<kind> of the exact spans, n_tagged, base_sha256, spans) for
    every row of ``docs``; a null text counts as empty."""
    finder = finder.train()
    kinds = finder.kinds
    names = ["doc_id", *[f"n_{k}" for k in kinds], "n_tagged", "base_sha256", "spans"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = finder.find(texts)
            columns = [batch.column(0)]
            columns += [pa.array([sum(x[0] == k for x in exact) for exact, _ in found], pa.int64()) for k in kinds]
            columns.append(pa.array([len(every) - len(exact) for exact, every in found], pa.int64()))
            columns.append(pa.array([sha256(joined(exact).encode()).hexdigest() for exact, _ in found], pa.string()))
            columns.append(pa.array([joined(every) for _, every in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    small_batches(docs.sparkSession)
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in kinds) + \
        ", n_tagged long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, schema)


def shape(token: str) -> str:
    """Letters as x or X, digits as 9, other characters as they are; runs of
    one sort count once, and 16 are kept."""
    out: list[str] = []
    for c in token[:256]:
        kind = "9" if c.isdigit() else ("X" if c.isupper() else "x") if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
            if len(out) == 16:
                break
    return "".join(out)
