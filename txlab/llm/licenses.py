"""Licence notices in texts, by matching statistics over a suffix automaton.

The automaton is built over the words of all notice templates and of the short
base phrases. A text's words are streamed through it; at each place it gives the
longest run of words ending there that is part of any template. Long runs that
can't be extended are the matches. Matches of a template whose order agrees in
text and template, with small gaps, are chained; a chain that covers enough of
the template is a span with the template's label. Whole templates and base
phrases, also inside longer matches of others, are read from the state's chain
of suffixes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from txlab.llm.common import held_in_worker, ids_and_texts, texts_as_bytes, words
from txlab.llm.license_texts import TAGS, TEMPLATES

# Phrases that count wherever they stand, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Words of a match at least, the part of a template a chain must cover, and the
#: words that may be skipped between two matches of a chain, in text or template.
LEAST_WORDS = 3
COVERAGE = 0.8
GAP = 6


@dataclass
class _State:
    length: int
    link: int
    next: dict[int, int] = field(default_factory=dict)


class SuffixAutomaton:
    """All runs of words of several sequences; each state knows where its runs end."""

    def __init__(self, sequences: list[list[int]]):
        self.states = [_State(0, -1)]
        ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word, ends)
                ends[last].add((number, place))
        for k in sorted(range(1, len(self.states)), key=lambda s: -self.states[s].length):
            if self.states[k].link > 0:
                ends[self.states[k].link] |= ends[k]
        #: For each state the sequences and places at which its runs end.
        self.ends = [tuple(sorted(e)) for e in ends]

    def _new(self, length: int, link: int, following: dict[int, int], ends: list) -> int:
        self.states.append(_State(length, link, dict(following)))
        ends.append(set())
        return len(self.states) - 1

    def _extend(self, last: int, word: int, ends: list) -> int:
        states = self.states
        known = states[last].next.get(word)
        if known is not None and states[known].length == states[last].length + 1:
            return known
        if known is not None:
            return self._split(last, word, known, ends)
        current = self._new(states[last].length + 1, 0, {}, ends)
        p = last
        while p >= 0 and word not in states[p].next:
            states[p].next[word] = current
            p = states[p].link
        if p >= 0:
            q = states[p].next[word]
            states[current].link = q if states[q].length == states[p].length + 1 else self._split(p, word, q, ends)
        return current

    def _split(self, p: int, word: int, q: int, ends: list) -> int:
        states = self.states
        copy = self._new(states[p].length + 1, states[q].link, states[q].next, ends)
        states[q].link = copy
        while p >= 0 and states[p].next.get(word) == q:
            states[p].next[word] = copy
            p = states[p].link
        return copy

    def statistics(self, text: list[int]) -> Iterator[tuple[int, int]]:
        """For each word of the text the state and length of the longest run that ends there."""
        states, state, length = self.states, 0, 0
        for word in text:
            while state and word not in states[state].next:
                state = states[state].link
                length = states[state].length
            following = states[state].next.get(word)
            if following is None:
                state, length = 0, 0
            else:
                state, length = following, length + 1
            yield state, length


class Scanner:
    """Tags count only as a whole, templates also as chains of their parts."""

    def __init__(self, templates=TEMPLATES, phrases=None, tags=TAGS):
        phrases = BASE_PHRASES if phrases is None else phrases
        self.labels = [label for label, _ in (*templates, *tags)]
        sequences = [words(text.encode()) for _, text in (*templates, *tags)]
        base = [words(phrase.encode()) for phrase in phrases]
        self.numbers = {w: k for k, w in enumerate(dict.fromkeys(w for s in sequences + base for w in s))}
        coded = [[self.numbers[w] for w in s] for s in sequences + base]
        self.sizes = [len(s) for s in coded]
        self.automaton = SuffixAutomaton(coded)
        self.ends = [frozenset(e) for e in self.automaton.ends]
        self.coded = coded[: len(templates)]
        self.shorter = self._shorter()
        self.phrases = self._whole({len(sequences) + k: label for k, label in enumerate(phrases.values())})
        self.notices = self._whole(dict(enumerate(self.labels)))
        self.templates = len(templates)

    def _whole(self, names: dict[int, str]) -> list[tuple[tuple[int, str], ...]]:
        """For each state the whole sequences that its longest run ends with: words and name."""
        states = self.automaton.states
        last = {(number, self.sizes[number] - 1): (self.sizes[number], name) for number, name in names.items()}
        out: list[tuple[tuple[int, str], ...]] = [()] * len(states)
        for k in sorted(range(1, len(states)), key=lambda i: states[i].length):
            link = states[k].link
            own = {last[e] for e in self.ends[k] if e in last and states[link].length < last[e][0] <= states[k].length}
            out[k] = tuple(sorted(own | set(out[link])))
        return out

    def _shorter(self) -> list[tuple[tuple[int, int, int], ...]]:
        """For each state the templates and places at which only a shorter run of its suffixes ends, and its words."""
        states = self.automaton.states
        out: list[tuple[tuple[int, int, int], ...]] = [()] * len(states)
        for k in sorted(range(1, len(states)), key=lambda i: states[i].length):
            link = states[k].link
            if link > 0 and states[link].length >= LEAST_WORDS:
                own = sorted((n, end, states[link].length) for n, end in self.ends[link] - self.ends[k] if n < len(self.coded))
                out[k] = (*own, *out[link])
        return out

    def runs(self, text_words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Stretches of the text whose words all occur in templates, with their starts."""
        coded = list(map(self.numbers.get, text_words, [-1] * len(text_words)))
        start, n = 0, len(coded)
        while start < n:
            if coded[start] < 0:
                start += 1
                continue
            end = start
            while end < n and coded[end] >= 0:
                end += 1
            yield start, coded[start:end]
            start = end

    def scan(self, text_words: list[bytes]):
        """Base phrase places ``(start, label)`` and spans ``(first, last, label, covered)``."""
        places: list[tuple[int, str]] = []
        spans: dict[tuple[int, int, str], float] = {}
        matches: dict[int, list[tuple[int, int, int]]] = {}
        for start, coded in self.runs(text_words):
            before, held = 0, 0
            for k, (state, length) in enumerate([*self.automaton.statistics(coded), (0, 0)]):
                if held >= LEAST_WORDS:
                    # A run is a match in the templates in which the next word doesn't extend it. Templates
                    # that have only an end of the longest run match with that end.
                    word = coded[k] if k < len(coded) else -1
                    whole = ((number, end, held) for number, end in self.automaton.ends[before] if number < self.templates)
                    for number, end, size in (*whole, *self.shorter[before]):
                        if end + 1 == self.sizes[number] or self.coded[number][end + 1] != word:
                            matches.setdefault(number, []).append((start + k - 1, end, size))
                places += [(start + k - size + 1, label) for size, label in self.phrases[state] if size <= length]
                for size, label in self.notices[state]:
                    if size <= length:
                        spans[start + k - size + 1, start + k, label] = 1.0
                before, held = state, length
        for number, found in matches.items():
            for first, last, label, covered in self._chains(number, found):
                spans[first, last, label] = max(covered, spans.get((first, last, label), 0.0))
        return sorted(places), sorted((*span, covered) for span, covered in spans.items())

    def _chains(self, number: int, found: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, str, float]]:
        """Best chains of a template's matches, each extended from the best chain before it."""
        size = self.sizes[number]
        best: list[tuple[int, int]] = []  # words covered up to each match, and the match before
        for k, (last, end, length) in enumerate(found):
            covered, before = length, -1
            for j in range(k - 1, -1, -1):
                other, other_end, _ = found[j]
                if last - other > size + GAP + length:
                    break
                gain = min(length, last - other, end - other_end)
                if gain > 0 and last - length - other <= GAP and end - length - other_end <= GAP:
                    if best[j][0] + gain > covered:
                        covered, before = best[j][0] + gain, j
            best.append((covered, before))
        used = set()
        for k in sorted(range(len(found)), key=lambda i: (-best[i][0], i)):
            chain, at = [], k
            while at >= 0 and at not in used:
                chain.append(at)
                at = best[at][1]
            if at >= 0 or best[k][0] < COVERAGE * size:
                continue
            used.update(chain)
            first = found[chain[-1]]
            yield first[0] - first[2] + 1, found[k][0], self.labels[number], min(1.0, best[k][0] / size)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = held_in_worker("licenses", Scanner)
    place = pa.struct([("start", pa.int64()), ("label", pa.string())])
    ends = [("first", pa.int64()), ("last", pa.int64())]
    span = pa.struct([*ends, ("label", pa.string()), ("covered", pa.float64())])
    for batch in batches:
        counts, places, spans = [], [], []
        for text in texts_as_bytes(batch.column("text")):
            found = words(text)
            base, covered = scanner.scan(found)
            counts.append(len(found))
            places.append([{"start": s, "label": x} for s, x in base])
            spans.append([{"first": a, "last": b, "label": x, "covered": c} for a, b, x, c in covered])
        columns = [
            batch.column("doc_id"),
            pa.array(counts, pa.int64()),
            pa.array(places, pa.list_(place)),
            pa.array(spans, pa.list_(span)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "places", "spans"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, places, spans`` of each row.

    ``places`` has every start (in words from 0) of a base phrase with its label;
    phrases may overlap. ``spans`` has the first and last word of each stretch
    that covers a template, its label, and the part of the template's words that
    it has. A null, empty or wordless text has none. Rows stay apart, also equal
    ones and those without doc_id; other columns aren't read; an empty table
    gives no rows.
    """
    return ids_and_texts(docs).mapInArrow(
        _scan,
        "doc_id long, n_words long, places array<struct<start: long, label: string>>, "
        "spans array<struct<first: long, last: long, label: string, covered: double>>",
    )
