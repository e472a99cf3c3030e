"""Matching statistics and places against plain searches, and odd rows."""

import random

from txlab.llm.common import words
from txlab.llm.license_texts import BODIES, IDENTIFIERS, TAGS, TEMPLATES
from txlab.llm.licenses import BASE_PHRASES, Scanner, SuffixAutomaton, scan_licenses

BASE = [(words(p.encode()), label) for p, label in BASE_PHRASES.items()]


def places(text_words):
    return sorted(
        (i, label) for phrase, label in BASE for i in range(len(text_words)) if text_words[i : i + len(phrase)] == phrase
    )


def test_matching_statistics():
    rng = random.Random(1)
    for _ in range(200):
        sequences = [[rng.randrange(3) for _ in range(rng.randint(1, 8))] for _ in range(rng.randint(1, 5))]
        automaton, text = SuffixAutomaton(sequences), [rng.randrange(4) for _ in range(20)]
        for k, (state, length) in enumerate(automaton.statistics(text)):
            ends = {
                n: {(s, j) for s, seq in enumerate(sequences) for j in range(n - 1, len(seq)) if seq[j + 1 - n : j + 1] == text[k + 1 - n : k + 1]}
                for n in range(1, k + 2)
            }
            assert length == max((n for n in ends if ends[n]), default=0)
            if length:
                assert set(automaton.ends[state]) == ends[length]


def test_places_of_phrases():
    rng, scanner = random.Random(2), Scanner()
    known = [*scanner.numbers, b"x", b"y"]
    templates = [words(t.encode()) for _, t in TEMPLATES]
    for _ in range(3000):
        text = []
        for _ in range(rng.randint(0, 12)):
            kind = rng.random()
            if kind < 0.3:
                text += rng.choice(BASE)[0][: rng.randint(1, 4)]
            elif kind < 0.6:
                source = rng.choice(templates)
                low = rng.randrange(len(source))
                text += source[low : low + rng.randint(1, len(source))]
            else:
                text.append(rng.choice(known))
        assert scanner.scan(text)[0] == places(text)


def contains(text_words, some):
    return any(text_words[k : k + len(some)] == some for k in range(len(text_words)))


def test_a_body_with_a_changed_clause_is_one_span():
    """Whole licences, with a clause of their own in the middle, among other words."""
    scanner = Scanner()
    for label, text in BODIES:
        inside = words(text.encode())
        cut = len(inside) // 2
        for changed in ([*inside[:cut], b"except", b"on", b"weekends", *inside[cut:]], [*inside[:cut], *inside[cut + 4 :]]):
            spans = scanner.scan([b"our", b"terms", *changed, b"end"])[1]
            whole = [s for s in spans if s[2] == label and s[0] == 2 and s[1] == len(changed) + 1]
            assert whole and 0.8 <= whole[0][3] <= 1.0, label


def test_families_and_tags():
    scanner, labels = Scanner(), {label for label, _ in (*TEMPLATES, *TAGS)}
    assert len(labels) >= 30
    for label, names in IDENTIFIERS.items():
        for name in names:
            text = f"// SPDX-License-Identifier: {name}\nint main"
            assert {s[2] for s in scanner.scan(words(text.encode()))[1]} == {label}, name
    assert not scanner.scan(words(b"SPDX-License-Identifier: Homegrown-7"))[1]


def test_every_template_is_found_whole_and_with_a_gap():
    scanner = Scanner()
    for label, text in TEMPLATES:
        inside = words(text.encode())
        spans = scanner.scan([b"zz", b"of", *inside, b"the", b"zz"])[1]
        assert (2, len(inside) + 1, label, 1.0) in spans
        if len(inside) >= 10:
            half = len(inside) // 2
            spans = scanner.scan([*inside[:half], b"zz", *inside[half:]])[1]
            assert any(s[2] == label and s[0] == 0 and s[1] == len(inside) for s in spans)
            start = inside[: half // 2]
            # Notices are the start of some bodies.
            within = {other for other, notice in TEMPLATES if contains(start, words(notice.encode()))}
            assert not any(s[2] == label and s[3] == 1.0 for s in scanner.scan(start)[1]) or label in within


def test_odd_rows(table):
    long = "the license " * 30_000 + "all rights reserved"
    rows = [(1, None), (2, ""), (3, "..."), (4, "CC-BY cc by"), (4, "CC-BY cc by"), (None, "All Rights, reserved"), (5, long)]
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(p) for p in r.places]) for r in scan_licenses(table(rows)).collect()))
    assert got == [
        (0, 3, [(0, "reserved")]),
        (1, 0, []),
        (2, 0, []),
        (3, 0, []),
        (4, 4, [(0, "cc-by"), (2, "cc-by")]),
        (4, 4, [(0, "cc-by"), (2, "cc-by")]),
        (5, 60_003, [(60_000, "reserved")]),
    ]
    assert scan_licenses(table([])).count() == 0


def test_templates_after_words_of_another_template():
    scanner = Scanner()
    notice = (
        "you can redistribute it and/or modify it under the terms of the GNU {} General Public License as published "
        "by the Free Software Foundation"
    )
    plain = words(notice.format("Library").encode())
    before = words(b"This library is free software;")
    for first in ([], before):
        spans = scanner.scan([*first, *plain])[1]
        assert any(s[2] == "lgpl" and s[0] == len(first) and abs(s[3] - 24 / 25) < 1e-9 for s in spans), first
