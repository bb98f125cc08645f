"""License scans: templates of licence texts found in documents through a generalised suffix automaton.

1. One suffix automaton holds the words of all templates. It is built from the fixed texts below, so its size does not
   depend on the documents; it is built once per Python worker.
2. The words of a document are streamed through it. After each word the automaton gives the longest run of words that
   ends there and stands in some template (the matching statistics). Only stretches in which each two neighbouring
   words stand together in a template are streamed; elsewhere no match has more than one word.
3. Matches of `least` words or more that cannot be extended are anchors, at each place where a template has them. Anchors of a
   template that follow each other in both texts, with gaps of `most_gap` words at most, are chained; the best chain
   covers the most words of the template.
4. A chain that covers the share `least_share` of its template is a span and gives the template's label.

Nothing is shuffled; documents are read once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.license_texts import BASE_PHRASES, TEMPLATES
from claimflow.llm.tokens import in_portions, worker_memo

# A-Z become small, ASCII signs but letters and digits become spaces; other bytes stay as they are.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
LEAST_WORDS = 4  # of a match
LEAST_SHARE = 0.8  # of a template, to give its label
MOST_GAP = 16  # words between two matches of a chain, in either text
SPAN = "struct<template:string,label:string,first_word:long,last_word:long,covered:long,size:long>"
SCHEMA = (
    f"doc_id long, n_words long, base array<struct<label:string,word:long>>, spans array<{SPAN}>, best_share double"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """All runs of symbols of some sequences. A state stands for the runs that end at the same places."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[list[tuple[int, int]]] = [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for end, symbol in enumerate(sequence, 1):
                last = self._extended(last, symbol)
                own += [[] for _ in range(len(self.length) - len(own))]
                own[last].append((number, end))
        # The places of a state are its own and those of the states that are longer and link to it.
        self.ends = own
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] = self.ends[self.link[state]] + self.ends[state]

    def _new(self, length: int, link: int, after: dict[int, int]) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, state: int, over: int, symbol: int) -> int:
        """The state of the runs of `over` that are one symbol longer than the runs of `state`."""
        if self.length[over] == self.length[state] + 1:
            return over
        short = self._new(self.length[state] + 1, self.link[over], dict(self.next[over]))
        self.link[over] = short
        while state >= 0 and self.next[state].get(symbol) == over:
            self.next[state][symbol] = short
            state = self.link[state]
        return short

    def _extended(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:  # another sequence has this run already
            return self._split(last, self.next[last][symbol], symbol)
        new = self._new(self.length[last] + 1, 0, {})
        while last >= 0 and symbol not in self.next[last]:
            self.next[last][symbol] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, self.next[last][symbol], symbol)
        return new

    def matching_statistics(self, symbols: list[int]) -> Iterator[tuple[int, int]]:
        """(length, state) of the longest run that ends at each symbol and stands in a sequence."""
        state, length = 0, 0
        for symbol in symbols:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if symbol in self.next[state]:
                state, length = self.next[state][symbol], length + 1
            yield length, state


@dataclass(frozen=True)
class Anchor:
    template: int
    doc_start: int
    start: int
    size: int


class Scanner:
    """The templates as symbols, their automaton, and which symbols follow each other in a template."""

    def __init__(self, templates: dict[str, tuple[str, str]], phrases: dict[str, str]):
        self.names = list(templates)
        self.labels = [label for label, _ in templates.values()]
        texts = [words_of(text.encode()) for _, text in templates.values()]
        self.phrases = [(label, words_of(phrase.encode())) for phrase, label in phrases.items()]
        self.number: dict[bytes, int] = {}
        for words in [*texts, *(words for _, words in self.phrases)]:
            for w in words:
                self.number.setdefault(w, len(self.number) + 1)  # 0 stands for any other word
        self.sequences = [[self.number[w] for w in words] for words in texts]
        self.phrases = [(label, [self.number[w] for w in words]) for label, words in self.phrases]
        self.automaton = SuffixAutomaton(self.sequences)
        self._places: dict[int, list[tuple[int, int, int]]] = {}
        self.follows = np.zeros((len(self.number) + 1,) * 2, bool)
        for s in self.sequences:
            self.follows[s[:-1], s[1:]] = True

    def symbols(self, words: list[bytes]) -> np.ndarray:
        get = self.number.get
        return np.fromiter((get(w, 0) for w in words), np.int32, len(words))

    def base(self, symbols: np.ndarray) -> list[tuple[str, int]]:
        """(label, first word) of every place of a base phrase, by place."""
        found = []
        for label, phrase in self.phrases:
            n = len(symbols) - len(phrase) + 1
            if n > 0:
                here = np.ones(n, bool)
                for i, symbol in enumerate(phrase):
                    here &= symbols[i : n + i] == symbol
                found += [(label, int(at)) for at in np.flatnonzero(here)]
        return sorted(found, key=lambda f: (f[1], f[0]))

    def places(self, state: int) -> list[tuple[int, int, int]]:
        """(template, end, length): where the longest run of a state ends, and where only shorter ones of its ends do."""
        if state not in self._places:
            out, seen, at = [], set(), state
            while at > 0:
                out += [(*e, self.automaton.length[at]) for e in self.automaton.ends[at] if e not in seen]
                seen.update(self.automaton.ends[at])
                at = self.automaton.link[at]
            self._places[state] = out
        return self._places[state]

    def anchors(self, symbols: np.ndarray, least: int) -> Iterator[Anchor]:
        """Matches of `least` words or more that no word before or after extends, by their place in the document."""
        near = self.follows[symbols[:-1], symbols[1:]]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], near.view(np.int8), [0]])))
        for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if last - first + 1 < least:
                continue
            part = symbols[first : last + 1].tolist()
            statistics = list(self.automaton.matching_statistics(part))
            for end, (length, state) in enumerate(statistics, 1):
                if length < least:
                    continue
                # Places of the template where the next word goes on are left to the longer match.
                after = part[end] if end < len(part) else None
                for template, at, shorter in self.places(state):
                    sequence, size = self.sequences[template], min(shorter, length)
                    if size >= least and (after is None or at >= len(sequence) or sequence[at] != after):
                        yield Anchor(template, first + end - size, at - size, size)

    def spans(self, anchors: Iterator[Anchor], least_share: float, most_gap: int) -> tuple[list[tuple], float]:
        """(spans by place, best share): chains that cover enough of their template, none over another of its template."""
        by_template: dict[int, list[Anchor]] = defaultdict(list)
        for a in anchors:
            by_template[a.template].append(a)
        spans, best = [], 0.0
        for template, found in by_template.items():
            size = len(self.sequences[template])
            for covered, first, last in _chains(found, most_gap):
                best = max(best, covered / size)
                if covered >= least_share * size:
                    spans.append((self.names[template], self.labels[template], first, last, covered, size))
        return sorted(spans, key=lambda s: (s[2], s[3], s[0])), best


def _chains(anchors: list[Anchor], most_gap: int) -> list[tuple[int, int, int]]:
    """(words covered, first word, last word) of chains of one template's anchors, the best first, without overlaps.

    An anchor continues an earlier one when it starts later in both texts, leaves at most `most_gap` words out in each
    and adds words; what overlaps is counted once. A template's places bound how many anchors are near each other.
    """
    anchors = sorted(set(anchors), key=lambda a: (a.doc_start, a.start))
    score, before, head = [], [], []
    window = 0
    longest = max(a.size for a in anchors)
    for i, a in enumerate(anchors):
        best, source = a.size, -1
        while anchors[window].doc_start + longest + most_gap < a.doc_start:
            window += 1
        for j in range(window, i):
            b = anchors[j]
            doc_gap, gap = a.doc_start - b.doc_start - b.size, a.start - b.start - b.size
            if b.doc_start < a.doc_start and b.start < a.start and doc_gap <= most_gap and gap <= most_gap:
                added = a.size + min(doc_gap, gap, 0)
                if added > 0 and score[j] + added > best:
                    best, source = score[j] + added, j
        score.append(best)
        before.append(source)
        head.append(i if source < 0 else head[source])
    out, starts, ends = [], [], []  # what is taken, by place
    for i in sorted(range(len(anchors)), key=lambda i: (-score[i], anchors[i].doc_start)):
        first, last = anchors[head[i]].doc_start, anchors[i].doc_start + anchors[i].size - 1
        place = bisect_left(starts, first)
        if (place == 0 or ends[place - 1] < first) and (place == len(starts) or starts[place] > last):
            starts.insert(place, first)
            ends.insert(place, last)
            out.append((score[i], first, last))
    return out


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = BASE_PHRASES, least: int = LEAST_WORDS, least_share: float = LEAST_SHARE,
    most_gap: int = MOST_GAP,
) -> DataFrame:
    """(doc_id, n_words, base, spans, best_share): where base phrases stand, and what covers licence templates.

    `templates` maps a name to (label, text), `phrases` a phrase to its label. `base` has every place of a phrase, `spans`
    each chain that covers at least `least_share` of its template's words, both by place; words count from 0. best_share
    is the greatest share of a template that a chain covers, 0 without one.

    Null and empty texts have no words and no finds. Null ids stay; repeated rows and equal ids give a row each; an empty
    table gives none. Other columns are not passed on. A long text is scanned whole.
    """
    key = ("license scanner", tuple(templates.items()), tuple(phrases.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner: Scanner = worker_memo(key, lambda: Scanner(templates, phrases))
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1))
            for part in in_portions(rows, lambda r: len(r[1].as_buffer()), 8 << 20):
                out = []
                for doc_id, text in part:
                    words = words_of(text.as_py())
                    symbols = scanner.symbols(words)
                    spans, best = scanner.spans(scanner.anchors(symbols, least), least_share, most_gap)
                    out.append((doc_id, len(words), scanner.base(symbols), spans, best))
                ids, n_words, base, spans, best = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()),
                        pa.array([[{"label": x, "word": w} for x, w in b] for b in base], BASE_TYPE),
                        pa.array([[dict(zip(SPAN_NAMES, s)) for s in found] for found in spans], SPAN_TYPE),
                        pa.array(best, pa.float64()),
                    ],
                    ["doc_id", "n_words", "base", "spans", "best_share"],
                )

    text = F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit("").cast("binary"))
    return docs.select(F.col(id_col).cast("long"), text).mapInArrow(run, SCHEMA)


SPAN_NAMES = ["template", "label", "first_word", "last_word", "covered", "size"]
BASE_TYPE = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
SPAN_TYPE = pa.list_(pa.struct([(n, pa.string() if n in ("template", "label") else pa.int64()) for n in SPAN_NAMES]))


def summary(found: DataFrame) -> DataFrame:
    """Per document the places of base phrases and the labels of both kinds; the score is the best share."""
    base_labels = F.array_distinct(F.col("base.label"))
    every = F.array_distinct(F.concat(F.col("base.label"), F.col("spans.label")))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"), F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"), F.col("best_share").alias("score"),
    )
